"""Licence scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory. DataFrame operations only.

Each line of a text, and the text as a whole, is a segment. A segment's vector has the words of the templates by their counts
and each other distinct word once, all weighted by the inverse of how many segments of all documents hold them. Templates are
notices and whole licence texts; a licence may have several.

Segments are settled within their row. Of each template the rarest words are set aside until the others alone can't reach the
threshold: a segment without any word set aside is no match, which drops nearly all prose. What is left gets its products with
all templates in place, from a table of weights that is one constant as large as the templates. Only segments that reach the
threshold, were their other words as light as the commonest one, meet the counts of those words.

A document takes the template of its best segment. One whose segments of that kind make up enough of its words is a licence
file and speaks for its directory: documents without a licence of their own take that of the nearest directory above them
that has such a file, found by joining paths with each of their ancestors.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.llm.decontamination import words
from lexalign.llm.license_texts import TEMPLATES
from lexalign.llm.storage import Scratch, maybe_broadcast

THRESHOLD = 0.6
FILE_SHARE = 0.2
#: Sums of products differ in their last digits by the order of addition; bounds let that much through.
SLACK = 1e-5


def forms(templates: dict[str, str | list[str]]) -> list[tuple[str, str]]:
    """(licence, text) of all templates, in order."""
    return sorted((name, body) for name, bodies in templates.items() for body in ([bodies] if isinstance(bodies, str) else bodies))


def segments(docs: DataFrame, made: dict, gate=None) -> DataFrame:
    """(row, path, n_words, segment, size, ...): the lines of each text, numbered from 1, and the whole text as 0 if it has
    several. ``made`` names functions of a segment's words, each a column. ``gate`` tells by the words of the whole text whether
    it has any segments.

    Everything is made inside a generator's input, as a filter on a projected column would cut the text again."""
    lines = F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1), words)
    rows = docs.select("row", "path", lines.alias("lines"))
    whole = F.flatten("lines")
    if gate is not None:
        rows = rows.select("row", "path", F.explode(F.when(gate(whole), F.array("lines"))).alias("lines"))
    every = F.concat(F.array(F.when(F.size("lines") > 1, whole).otherwise(F.array().cast("array<string>"))), F.col("lines"))
    parts = F.transform(every, lambda w: F.struct(F.size(w).alias("size"), *[f(w).alias(name) for name, f in made.items()]))
    rows = rows.select("row", "path", F.size(whole).alias("n_words"), F.posexplode(parts).alias("segment", "s"))
    return rows.select("row", "path", "n_words", "segment", "s.size", *[f"s.{name}" for name in made]).where(F.col("size") > 0)


def _constant(value: list, kind: str) -> Column:
    """A nested array as one folded constant, where literals of its members would be planned one by one."""
    return F.from_json(F.lit(json.dumps({"x": value})), f"struct<x:{kind}>")["x"]


class Weights:
    """What the templates weigh among the counted documents: lists as long as the templates' words."""

    def __init__(self, spark: SparkSession, counts: DataFrame, templates: dict[str, str | list[str]], threshold: float):
        self.forms = forms(templates)
        table = spark.createDataFrame([(i, body) for i, (_, body) in enumerate(self.forms)], "form int, body string")
        table = table.select("form", F.explode(words(F.col("body"))).alias("word")).groupBy("form", "word").agg(F.count("*").alias("tf")).collect()  # the parameter's words
        self.vocabulary = sorted({r.word for r in table}) or [""]
        known = spark.createDataFrame([(w,) for w in self.vocabulary], "word string")
        self.total = counts.where("word = ''").agg(F.coalesce(F.max("df"), F.lit(0))).first()[0]
        df = {r.word: r.df for r in counts.join(F.broadcast(known), "word").collect()}
        common = counts.where(F.col("word") != "").join(F.broadcast(known), "word", "left_anti")
        self.least = self.idf(common.agg(F.coalesce(F.max("df"), F.lit(0))).first()[0])
        idf = {w: self.idf(df.get(w, 0)) for w in self.vocabulary}
        place = {w: i for i, w in enumerate(self.vocabulary)}
        self.squares = [idf[w] ** 2 for w in self.vocabulary]
        #: By word and form: what one of the word adds to the cosine's product, over the form's length.
        self.products = [[0.0] * len(self.forms) for _ in self.vocabulary]
        self.rare: set[str] = set()
        for i in range(len(self.forms)):
            mine = {r.word: r.tf for r in table if r.form == i}
            square = sum((tf * idf[w]) ** 2 for w, tf in mine.items())
            rest = square
            for w in sorted(mine, key=lambda w: (-idf[w], w)):
                self.products[place[w]][i] = mine[w] * idf[w] ** 2 / math.sqrt(square)
                if rest >= (threshold - SLACK) ** 2 * square:
                    self.rare.add(w)
                rest -= (mine[w] * idf[w]) ** 2

    def idf(self, df: int) -> float:
        return math.log((1.0 + self.total) / (1.0 + df)) + 1

    def idf_of(self, df: Column) -> Column:
        return F.log((F.lit(1.0) + self.total) / (F.lit(1.0) + df)) + 1


def matches(spark: SparkSession, docs: DataFrame, templates: dict[str, str | list[str]], threshold: float, scratch: Scratch) -> DataFrame:
    """(row, segment, n_words, size, license, cosine): segments with their best template, if it reaches the threshold."""
    counted = segments(docs, {"w": F.array_distinct}).select(F.explode(F.concat("w", F.array(F.lit("")))).alias("word"))
    counts = scratch.cut(counted.groupBy("word").agg(F.count("*").alias("df")))  # the empty word counts all segments
    known = Weights(spark, counts, templates, threshold)
    vocabulary, rare = _constant(known.vocabulary, "array<string>"), _constant(sorted(known.rare), "array<string>")
    products, squares = _constant(known.products, "array<array<double>>"), _constant(known.squares, "array<double>")
    nothing = F.array().cast("array<string>")
    has_rare = lambda w: F.arrays_overlap(w, rare)
    rows = segments(docs, {"w": lambda w: F.when(has_rare(w), w).otherwise(nothing)}, has_rare).where(F.size("w") > 0)
    # each step is a generator of one row, lest the next one's filter makes it anew
    step = lambda df, **made: df.select(*df.columns, F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("s")).select(*df.columns, *[f"s.{n}" for n in made])
    count = lambda x: (F.size("w") - F.size(F.array_remove("w", x))).cast("double")
    terms = F.transform(F.array_intersect("w", vocabulary), lambda x: F.struct(F.array_position(vocabulary, x).cast("int").alias("at"), count(x).alias("tf")))
    rows = step(rows, terms=terms, n_others=F.size(F.array_except("w", vocabulary)))
    add = lambda acc, t: F.zip_with(acc, F.element_at(products, t["at"]), lambda a, c: a + t["tf"] * c)
    dots = F.aggregate("terms", F.array_repeat(F.lit(0.0), len(known.forms)), add)
    square = F.aggregate("terms", F.lit(0.0), lambda acc, t: acc + t["tf"] * t["tf"] * F.element_at(squares, t["at"]))
    rows = step(rows, dots=dots, square=square)
    reach = F.array_max("dots") >= (threshold - SLACK) * F.sqrt(F.col("square") + F.col("n_others") * known.least**2)
    near = scratch.cut(rows.where(reach).select("row", "segment", "n_words", "size", "dots", "square", F.array_except("w", vocabulary).alias("others")))
    # the other words of what is still in reach, with the weights they have
    rest = near.select("row", "segment", F.explode("others").alias("word"))
    weights = scratch.cut(counts.join(rest.select("word").distinct(), "word").select("word", known.idf_of(F.col("df")).alias("idf")))
    rest = rest.join(maybe_broadcast(weights, 64), "word").groupBy("row", "segment").agg(F.sum(F.pow("idf", F.lit(2))).alias("rest"))
    length = F.sqrt(F.col("square") + F.coalesce("rest", F.lit(0.0)))
    names = _constant([name for name, _ in known.forms], "array<string>")
    every = F.zip_with("dots", names, lambda d, name: F.struct((-F.round(d / length, 6)).alias("c"), name.alias("license")))
    best = near.join(rest, ["row", "segment"], "left").withColumn("best", F.array_min(every)).where(-F.col("best.c") >= threshold)
    return best.select("row", "segment", "n_words", "size", "best.license", (-F.col("best.c")).alias("cosine"))


def parent(path: Column) -> Column:
    """The directory of a path; that of a bare name is the empty path."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(spark: SparkSession, docs: DataFrame, templates: dict[str, str | list[str]] | None = None, threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> DataFrame:
    """(doc_id, path, own_license, cosine, license, origin, license_dir) for a table (doc_id, path, text).

    ``origin`` is header, inherited or none; ``license_dir`` the directory of the file it comes from. Ties go to the larger
    cosine, then the licence that sorts first; of a directory's files the one with the largest cosine speaks, then the licence
    that sorts first. Null and wordless texts have no licence of their own but inherit. A null path is in no directory.
    A text of any length is one whole segment beside its lines. Repeated rows each get their result. Other columns are
    ignored. An empty table gives an empty result. ``templates`` has one text or several for each licence.
    """
    scratch = Scratch(spark, "licenses")
    templates = TEMPLATES if templates is None else templates
    rows = docs.select("doc_id", F.col("path").cast("string").alias("path"), F.col("text").cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    found = scratch.cut(matches(spark, rows, templates, threshold, scratch))
    first = F.struct((-F.col("cosine")).alias("c"), F.col("license"))
    covered = F.greatest(F.sum(F.when(F.col("segment") > 0, F.col("size"))), F.max(F.when(F.col("segment") == 0, F.col("size"))))
    own = found.groupBy("row").agg(F.min(first).alias("best"), (covered / F.first("n_words") >= file_share).alias("speaks"))
    own = rows.drop("text").join(own.select("row", F.col("best.license").alias("own_license"), (-F.col("best.c")).alias("cosine"), "speaks"), "row", "left")
    own = scratch.cut(own.withColumn("dir", parent(F.col("path"))))
    files = own.where("speaks AND dir IS NOT NULL").groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), F.col("own_license").alias("license"))).alias("best"))
    files = files.select(F.col("dir").alias("license_dir"), F.col("best.license").alias("inherited"))
    parts = F.split("dir", "/")
    ups = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    dirs = own.where("own_license IS NULL AND dir IS NOT NULL").select("dir").distinct().select("dir", F.explode(F.array_distinct(ups)).alias("license_dir"))
    near = dirs.join(files, "license_dir").groupBy("dir").agg(F.max_by(F.struct("license_dir", "inherited"), F.length("license_dir")).alias("near"))
    out = own.join(near.select("dir", "near.license_dir", "near.inherited"), "dir", "left")
    mine = F.col("own_license").isNotNull()
    origin = F.when(mine, "header").when(F.col("inherited").isNotNull(), "inherited").otherwise("none")
    return out.select("doc_id", "path", "own_license", "cosine", F.coalesce("own_license", "inherited").alias("license"), origin.alias("origin"), F.when(mine, F.col("dir")).otherwise(F.col("license_dir")).alias("license_dir"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan(spark, docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"))


def sql(templates: dict[str, str | list[str]] | None = None, threshold: float = THRESHOLD, file_share: float = FILE_SHARE) -> str:
    quoted = lambda x: "'" + x.replace("'", "''").replace("\n", " ") + "'"
    values = ", ".join(f"({i}, {quoted(name)}, {quoted(body)})" for i, (name, body) in enumerate(forms(TEMPLATES if templates is None else templates)))
    cut = r"list_filter(string_split_regex(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')".format
    return f"""
WITH t AS (SELECT form, license, word, CAST(count(*) AS DOUBLE) AS tf FROM (SELECT form, license, unnest({cut("body")}) AS word FROM (VALUES {values}) v(form, license, body)) GROUP BY 1, 2, 3),
d AS (SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, coalesce(text, '') AS text, len({cut("text")}) AS n_words FROM documents),
lines AS (SELECT doc_id, n_words, string_split(text, chr(10)) AS l, text FROM d),
seg AS (
  SELECT doc_id, n_words, i AS segment, {cut("l[i]")} AS w FROM (SELECT *, unnest(generate_series(1, len(l))) AS i FROM lines)
  UNION ALL SELECT doc_id, n_words, 0, {cut("text")} FROM lines WHERE len(l) > 1),
s AS (SELECT * FROM seg WHERE len(w) > 0),
n AS (SELECT CAST(count(*) AS DOUBLE) AS total FROM s),
vocab AS (SELECT DISTINCT word FROM t),
words AS (SELECT doc_id, segment, n_words, len(w) AS size, unnest(w) AS word FROM s),
tf AS (SELECT doc_id, segment, n_words, size, word, CAST(count(*) AS DOUBLE) AS tf FROM words GROUP BY ALL),
df AS (SELECT word, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY word),
idf AS (SELECT word, ln((1.0 + total) / (1.0 + coalesce(df, 0))) + 1 AS idf, vocab.word IS NOT NULL AS inside FROM df FULL JOIN vocab USING (word), n),
norm AS (SELECT form, sqrt(sum(pow(tf * idf, 2))) AS norm FROM t JOIN idf USING (word) GROUP BY form),
length AS (SELECT doc_id, segment, sqrt(sum(pow(CASE WHEN inside THEN tf ELSE 1 END * idf, 2))) AS length FROM tf JOIN idf USING (word) GROUP BY 1, 2),
dot AS (SELECT doc_id, segment, n_words, size, form, license, sum(tf.tf * t.tf * idf * idf) AS dot FROM tf JOIN idf USING (word) JOIN t USING (word) GROUP BY ALL),
found AS (
  SELECT doc_id, segment, n_words, size, license, round(dot / (norm * length), 6) AS cosine
  FROM dot JOIN norm USING (form) JOIN length USING (doc_id, segment)),
best AS (
  SELECT * FROM found WHERE cosine >= {threshold}
  QUALIFY row_number() OVER (PARTITION BY doc_id, segment ORDER BY cosine DESC, license) = 1),
own AS (
  SELECT doc_id, arg_min(license, struct_pack(c := -cosine, l := license)) AS own_license, max(cosine) AS cosine,
         greatest(coalesce(sum(size) FILTER (WHERE segment > 0), 0), coalesce(max(size) FILTER (WHERE segment = 0), 0)) / any_value(n_words) >= {file_share} AS speaks
  FROM best GROUP BY doc_id),
o AS (SELECT d.doc_id, path, own_license, cosine, speaks, regexp_replace(path, '/?[^/]*$', '') AS dir FROM d LEFT JOIN own USING (doc_id)),
files AS (SELECT dir AS license_dir, arg_min(own_license, struct_pack(c := -cosine, l := own_license)) AS inherited FROM o WHERE speaks GROUP BY dir),
near AS (
  SELECT dir, license_dir, inherited FROM (SELECT DISTINCT dir FROM o) x JOIN files ON dir = license_dir OR license_dir = '' OR starts_with(dir, license_dir || '/')
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY length(license_dir) DESC) = 1)
SELECT doc_id, path, own_license, cosine, coalesce(own_license, inherited) AS license,
       CASE WHEN own_license IS NOT NULL THEN 'header' WHEN inherited IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN own_license IS NOT NULL THEN o.dir ELSE license_dir END AS license_dir
FROM o LEFT JOIN near ON o.dir = near.dir
"""
