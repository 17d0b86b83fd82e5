"""Repairs of tokens and units. Each is a transform, so that a pipeline is a chain of them; what needs a sequential scan over
tokens is Arrow code in :mod:`lexalign.operators.token_kernels`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.operators import roles as R
from lexalign.operators import tokens as K
from lexalign.operators.token_kernels import canonical, rebalance_lines, reconcile, strip_note_tokens

__all__ = ["canonical", "rebalance_lines", "reconcile", "strip_note_tokens"]


def normal_roles(tokens: DataFrame) -> DataFrame:
    """Rows (t, r, g, role, syntax) with the present role key and names only."""
    return tokens.withColumn("g", X.role(F.coalesce("g", "role", "syntax"))).withColumn("r", X.empty(F.col("r"))).drop("role", "syntax")


def normal_ruby(tokens: DataFrame, keys: list[str], fallback: Column | None = None) -> DataFrame:
    """Rows (keys, lang, line, tok, t, r, g) with ruby on single characters only, numbered anew."""
    parts = F.when(F.col("lang") == "zh", K.split_reading(F.col("t"), F.col("r"), F.col("g"), "zh")).otherwise(K.split_reading(F.col("t"), F.col("r"), F.col("g"), "ja", fallback))
    rows = tokens.select(*keys, "lang", "line", "tok", F.posexplode(parts).alias("_at", "x"))
    place = F.row_number().over(W.partitionBy(*keys, "lang", "line").orderBy("tok", "_at")) - 1
    return rows.select(*keys, "lang", "line", place.alias("tok"), "x.t", "x.r", "x.g")


def synced_components(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Markers take the role before them, and lists of things are objects."""
    rows = tokens.withColumn("ord", F.col("tok"))
    line = [*keys, "lang", "line"]
    zh = R.inherit(rows.where("lang = 'zh'"), line, "zh")
    ja = R.inherit(R.promote_lists(R.inherit(rows.where("lang = 'ja'"), line, "ja"), line), line, "ja")
    return zh.unionByName(ja).drop("ord")


def backfilled_readings(tokens: DataFrame, readings: DataFrame) -> DataFrame:
    """Single Chinese characters of a language without a reading take that of a table (lang, t, reading), which is broadcast
    if it is small."""
    rows = tokens.join(readings.select("lang", "t", F.col("reading").alias("_r")).dropDuplicates(["lang", "t"]), ["lang", "t"], "left")
    needs = X.is_single_han(F.col("t")) & (X.empty(F.col("r")) == "")
    return rows.withColumn("r", F.when(needs, X.empty(F.col("_r"))).otherwise(F.col("r"))).drop("_r")


def shortened_comments(units: DataFrame, stock: Column) -> DataFrame:
    """Units (source_text, ja as array of token lines) whose second line is longer than 42 characters and than four times the
    source get the stock comment instead."""
    most = F.greatest(F.lit(42), F.length(X.compact(F.col("source_text"))) * 4)
    long = (F.size("ja") == 2) & (X.empty(F.col("source_text")) != "") & (F.length(X.compact(K.surface(F.get("ja", F.lit(1))))) > most)
    return units.withColumn("ja", F.when(F.coalesce(long, F.lit(False)), F.array(F.get("ja", F.lit(0)), stock)).otherwise(F.col("ja")))


def restored_ending(zh: Column, source: Column) -> Column:
    """Token text with the marks at the end of the source that it lacks; what it lacks must hold no Chinese character."""
    a, b = X.compact(zh), X.compact(source)
    rest = F.substring(b, F.length(a) + 1, F.length(b))
    return F.when(F.startswith(b, a) & (rest != "") & ~X.has_han(rest), F.concat(zh, rest)).otherwise(zh)


def cut_tail(tokens: DataFrame, keys: list[str], targets: DataFrame) -> DataFrame:
    """Tokens of a paragraph up to the length of its target (keys, size), where they are longer; the last may be cut."""
    order = W.partitionBy(*keys).orderBy("ord")
    end = F.sum(F.length("t")).over(order.rowsBetween(W.unboundedPreceding, 0))
    rows = tokens.withColumn("_end", end).join(targets, keys)
    rows = rows.where(F.col("_end") - F.length("t") < F.col("size"))
    return rows.withColumn("t", F.left("t", F.least(F.length("t"), (F.col("size") - F.col("_end") + F.length("t")).cast("int")))).drop("_end", "size")


def aligned_sources(units: DataFrame, most: int = 3) -> DataFrame:
    """Units whose source differs from their tokens by a few marks at the end take the tokens' text as source."""
    a, b = X.compact(F.col("source_text")), X.compact(F.col("zh_text"))
    near = (F.abs(F.length(a) - F.length(b)) <= most) & (F.startswith(a, b) | F.startswith(b, a))
    return units.withColumn("source_text", F.when(near, F.col("zh_text")).otherwise(F.col("source_text")))


def swapped_back(tokens: DataFrame) -> DataFrame:
    """Rows (t, r, g) with reading and role in their places."""
    return tokens.withColumn("_x", X.swapped(X.empty(F.col("t")), F.col("r"), F.col("g"))).withColumn("r", F.col("_x.r")).withColumn("g", F.col("_x.g")).drop("_x")


def inferred_ja(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Japanese tokens without a role: single Chinese characters by their usual one, the particle behind them or an ending that
    makes a verb, else attributive; particles and what begins with one by the particle."""
    t = X.empty(F.col("t"))
    behind = X.empty(F.lead("t").over(W.partitionBy(*keys).orderBy("ord")))
    starts = lambda c: [(F.startswith(c, F.lit(p)), role) for p, role in R.JA_PARTICLES.items()]

    def first(cases: list, otherwise: Column) -> Column:
        out = None
        for test, role in cases:
            out = F.when(test, role) if out is None else out.when(test, role)
        return out.otherwise(otherwise)

    usual = [(t.isin(*R.JA_FUNCTION), "function"), (t.isin(*R.JA_ADVERBIAL), "adverbial"), (t.isin(*R.JA_PREDICATE), "predicate")]
    kanji = first(usual + starts(behind) + [(behind.rlike(R.JA_VERB_ENDING), "predicate")], F.lit("attributive"))
    kana = first([(t == p, role) for p, role in R.JA_PARTICLES.items()] + starts(t), F.lit(""))
    plain = (t != "") & ~X.has_han(t) & ~t.rlike(X.PUNCTUATION)
    new = F.when(X.is_single_han(t), kanji).when(plain, kana).otherwise("")
    rows = tokens.withColumn("_new", new)
    return rows.withColumn("g", F.when(X.empty(F.col("g")) == "", F.col("_new")).otherwise(F.col("g"))).drop("_new")


# Pipelines. Tokens are rows (keys, lang, line, tok, t, r, g), and what a pipeline gives has the same columns.


def _by_line(tokens: DataFrame, keys: list[str], zh, ja) -> DataFrame:
    """Passes for either language over the lines of tokens, which have their place as ``ord`` meanwhile."""
    line = [*keys, "lang", "line"]
    rows = tokens.withColumn("ord", F.col("tok"))
    return zh(rows.where("lang = 'zh'"), line).unionByName(ja(rows.where("lang = 'ja'"), line)).drop("ord")


def normalized(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Role names put right, then components: the repair of a chunk that is otherwise sound. Rows have role and syntax besides."""
    return normal_roles(tokens).transform(synced_components, keys)


def backfilled_roles(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """Missing roles from the words themselves, after readings and roles were exchanged where they had been."""
    return _by_line(swapped_back(tokens), keys, R.infer_zh, inferred_ja)


def mechanical(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """The repair of a rejected candidate: role names, ruby on single characters, missing roles by the nearest, components, lines of
    nearly one role dealt anew, and components again. Rows have role and syntax besides."""
    rows = normal_roles(tokens).transform(normal_ruby, keys).transform(_by_line, keys, R.fill_nearest, R.fill_nearest).transform(synced_components, keys)
    rows = rows.transform(_by_line, keys, lambda x, line: R.rebalance(x, line, "zh"), lambda x, line: R.rebalance(x, line, "ja"))
    return rows.transform(synced_components, keys)


def compacted(tokens: DataFrame, keys: list[str], targets: DataFrame, readings: DataFrame) -> DataFrame:
    """The repair of an accepted form: Chinese tokens cut to the length of their target (keys, size), readings from a table, and
    missing roles."""
    order = F.struct("line", "tok")
    zh = cut_tail(tokens.where("lang = 'zh'").withColumn("ord", order), keys, targets).drop("ord")
    rows = zh.unionByName(tokens.where("lang <> 'zh'"))
    return backfilled_readings(rows, readings).transform(backfilled_roles, keys)


def promoted(outputs: DataFrame, issues: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Outputs with ``state``: reviewed without issues, quarantined with."""
    bad = issues.groupBy(key).agg(F.count("*").alias("errors"))
    return outputs.join(bad, key, "left").withColumn("errors", F.coalesce("errors", F.lit(0))).withColumn("state", F.when(F.col("errors") == 0, "reviewed").otherwise("quarantined"))
