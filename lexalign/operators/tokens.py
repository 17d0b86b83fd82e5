"""Books, chunks and units as token tables, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.schema import HAN, LINE_ROLES, TOKEN


def surface(tokens: Column) -> Column:
    """Tokens joined to their text."""
    return F.coalesce(F.array_join(F.transform(tokens, lambda x: X.empty(x["t"])), ""), F.lit(""))


def lines_text(ja: Column) -> Column:
    return surface(F.flatten(F.filter(ja, lambda x: x.isNotNull())))


def target(corrected: Column, source: Column) -> Column:
    """What the tokens must reconstruct: the corrected text, or else the source."""
    return F.coalesce(F.nullif(X.strip(corrected), F.lit("")), X.empty(source))


def plain_token(x: Column) -> Column:
    """A token of the present format: older role keys folded into ``g``."""
    old = F.coalesce(x["g"], x["role"], x["syntax"])
    return F.struct(x["t"].alias("t"), X.empty(x["r"]).alias("r"), X.role(old).alias("g"))


def book_paragraphs(books: DataFrame, id: str = "book_id") -> DataFrame:
    """(book_id, section, subsection, story, para, paragraph): paragraphs of nested books, numbered in order from 0."""
    rows = books.select(id, F.posexplode("sections").alias("section", "s"))
    rows = rows.select(id, "section", F.posexplode("s.subsections").alias("subsection", "u"))
    rows = rows.select(id, "section", "subsection", F.posexplode("u.stories").alias("story", "y"))
    return rows.select(id, "section", "subsection", "story", F.posexplode("y.paragraphs").alias("para", "paragraph"))


def paragraph_units(rows: DataFrame) -> DataFrame:
    """Units of ``paragraph``, numbered from 0, beside all other columns."""
    keep = [c for c in rows.columns if c != "paragraph"]
    return rows.select(*keep, F.col("paragraph.id").alias("para_id"), F.posexplode("paragraph.units").alias("unit", "u"))


def unit_tokens(units: DataFrame) -> DataFrame:
    """(…, lang, line, tok, t, r, g): a row for each token; zh is line 0, the lines of ja follow from 0."""
    keep = [c for c in units.columns if c != "u"]
    empty = F.array().cast("array<struct<t:string,r:string,g:string,role:string,syntax:string>>")
    zh = F.struct(F.lit("zh").alias("lang"), F.lit(0).alias("line"), F.coalesce(F.col("u.zh"), empty).alias("tokens"))
    ja = F.transform(F.coalesce(F.col("u.ja"), F.array().cast("array<array<struct<t:string,r:string,g:string,role:string,syntax:string>>>")), lambda x, i: F.struct(F.lit("ja").alias("lang"), i.alias("line"), F.coalesce(x, empty).alias("tokens")))
    rows = units.select(*keep, F.explode(F.concat(F.array(zh), ja)).alias("l")).select(*keep, "l.lang", "l.line", F.posexplode("l.tokens").alias("tok", "x"))
    return rows.select(*keep, "lang", "line", "tok", "x.t", "x.r", "x.g", "x.role", "x.syntax")


def token_path(columns: list[str]) -> Column:
    """A token's address in its book, as in ``/sections/0/.../zh/3``."""
    return F.concat(*[F.concat(F.lit(f"/{c}/"), F.col(c).cast("string")) for c in columns])


def nest_lines(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lang, line, tokens): rows of tokens back to arrays."""
    nested = F.transform(F.array_sort(F.collect_list(F.struct("tok", "t", "r", "g"))), lambda x: F.struct(x["t"].alias("t"), x["r"].alias("r"), x["g"].alias("g")))
    return tokens.groupBy(*keys, "lang", "line").agg(nested.alias("tokens"))


def nest_units(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, zh, ja): lines back to units."""
    kind = f"array<{TOKEN.simpleString()}>"
    zh = F.coalesce(F.first(F.when(F.col("lang") == "zh", F.col("tokens")), True), F.array().cast(kind))
    ja = F.transform(F.array_sort(F.collect_list(F.when(F.col("lang") == "ja", F.struct("line", "tokens")))), lambda x: x["tokens"])
    return lines.groupBy(*keys).agg(zh.alias("zh"), ja.alias("ja"))


def with_line_roles(ja: Column, roles: Column) -> Column:
    """The usual roles of two lines where none are given."""
    return F.when((F.size(ja) == 2) & (F.coalesce(F.size(roles), F.lit(0)) != 2), F.array(*[F.lit(r) for r in LINE_ROLES])).otherwise(roles)


def compact_units(paragraphs: Column) -> Column:
    return F.flatten(F.transform(paragraphs, lambda p: p["units"]))


def apply_edits(tokens: DataFrame, edits: DataFrame, path: list[str]) -> tuple[DataFrame, DataFrame]:
    """Tokens with the roles of edits (path, t, g) whose text is still theirs, and the edits that no longer fit."""
    new = edits.select(*path, F.col("t").alias("_t"), F.col("g").alias("_g"))
    out = tokens.join(new, path, "left").withColumn("g", F.when(F.col("_t") == F.col("t"), F.col("_g")).otherwise(F.col("g"))).drop("_t", "_g")
    stale = new.join(tokens.select(*path, "t"), path, "left").where("t IS NULL OR t <> _t").select(*path, F.col("_t").alias("t"), F.col("_g").alias("g"))
    return out, stale


def title_tokens(title: Column, readings: Column) -> Column:
    """A token for each character, with its reading from a map."""
    return F.transform(X.characters(title), lambda c: F.struct(c.alias("t"), F.coalesce(F.element_at(readings, c), F.lit("")).alias("r")))


def tokens_with_readings(text: Column, reading: Column) -> Column:
    """A token for each character; readings, cut at blanks and slashes, go to the Chinese characters in turn, and a character
    that is itself the next reading uses it up."""
    parts = F.filter(F.split(X.empty(reading), r"(?U)[\s/／・,，]+"), lambda x: x != "")
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<t:string,r:string>>").alias("out"))

    def step(acc: Column, c: Column) -> Column:
        following = F.get(parts, acc["at"])
        han = X.is_single_han(c)
        r = F.when(han, F.coalesce(following, F.lit(""))).otherwise(F.lit(""))
        used = F.when((han & following.isNotNull()) | (~han & F.coalesce(following == c, F.lit(False))), 1).otherwise(0)
        return F.struct((acc["at"] + used).alias("at"), F.concat(acc["out"], F.array(F.struct(c.alias("t"), r.alias("r")))).alias("out"))

    return F.aggregate(X.characters(text), zero, step, lambda acc: acc["out"])


def split_reading(t: Column, r: Column, g: Column, lang: str, fallback: Column | None = None) -> Column:
    """A token as tokens with ruby on single Chinese characters only.

    A reading on text without any is dropped. One such character among others keeps it, and the rest stands beside it. A
    Chinese word with as many readings as characters is spelled out; a Japanese one without a reading too, with readings of
    ``fallback`` if there are any.
    """
    t, r, g = X.empty(t), X.empty(r), X.empty(g)
    one = lambda a, b: F.struct(a.alias("t"), b.alias("r"), g.alias("g"))
    none = F.lit("")
    runs = F.regexp_extract_all(t, F.lit(f"[{HAN}]|[^{HAN}]+"), F.lit(0))
    n_han = F.size(F.filter(runs, X.is_single_han))
    readings = F.filter(F.split(r, r"(?U)\s+"), lambda x: x != "")
    spelled = F.zip_with(runs, readings, one)
    known = (lambda x: F.coalesce(F.element_at(fallback, x), none)) if fallback is not None else (lambda x: none)
    same = F.array(one(t, r))
    single = F.transform(runs, lambda x: one(x, F.when(X.is_single_han(x), r).otherwise(none)))
    out = F.when((r != "") & (n_han == 0), F.array(one(t, none))).when((r != "") & (n_han == 1) & (F.size(runs) > 1), single)
    if lang == "zh":
        return out.when((r != "") & (n_han > 1) & (F.size(runs) == n_han) & (F.size(readings) == n_han), spelled).otherwise(same)
    return out.when((r == "") & (n_han > 0) & (F.size(runs) > 1), F.transform(runs, lambda x: one(x, F.when(X.is_single_han(x), known(x)).otherwise(none)))).otherwise(same)


def mismatch(expected: Column, got: Column, width: int = 20) -> Column:
    """Struct (at, expected, got): length of what both begin with, and a clip of each around its end."""
    n = F.least(F.length(expected), F.length(got))
    ends = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i <= n) & (F.substring(expected, i, F.lit(1)) != F.substring(got, i, F.lit(1))))
    at = F.coalesce(F.array_min(ends) - 1, n)
    clip = lambda c: F.substring(c, F.greatest(at - width + 1, F.lit(1)), F.lit(2 * width))
    return F.struct(at.alias("at"), clip(expected).alias("expected"), clip(got).alias("got"))
