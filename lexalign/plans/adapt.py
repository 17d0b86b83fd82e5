"""The driver's tables in the shapes of the library: a paragraph is a line of a document that isn't blank, a section a source,
a token a word, and a role follows a word's length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.functions import text as X
from lexalign.schema import ROLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry() -> tuple[dict, dict, Callable]:
    """Queries, SQL, and a decorator that enters a query in both."""
    queries: dict = {}
    sql: dict[str, str] = {}

    def query(text: str | None = None) -> Callable:
        def enter(f: Callable) -> Callable:
            queries[f.__name__] = f
            if text:
                sql[f.__name__] = text
            return f

        return enter

    return queries, sql, query


def values(rows: list[tuple]) -> str:
    """Rows as a list for ``VALUES``."""
    one = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else str(x) if isinstance(x, int | float) else "'" + x.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, ord, line, lang, source)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("doc"), "lang", "source", F.posexplode(X.lines(F.col("text"))).alias("ord", "line"))


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).where(X.strip(F.col("line")) != "")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc, line, ord, lang, source, t, g): words of each line; a word whose length five divides has no role."""
    rows = paragraphs(spark, sf_dir).select("doc", F.col("ord").alias("line"), "lang", "source", F.posexplode(F.filter(F.split("line", " "), lambda x: x != "")).alias("ord", "t"))
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), (F.length("t") % 8 + 1).cast("int"))
    return rows.withColumn("g", F.when(F.length("t") % 5 == 0, "").otherwise(role))


LINES = """lines AS (
  SELECT doc, lang, source, i - 1 AS ord, l[i] AS line
  FROM (SELECT *, unnest(generate_series(1, len(l))) AS i FROM (SELECT doc_id AS doc, lang, source, string_split(text, chr(10)) AS l FROM documents))),
paragraphs AS (SELECT * FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> '')"""
TOKENS = LINES + """,
words AS (SELECT doc, ord AS line, lang, source, list_filter(string_split(line, ' '), lambda x: x <> '') AS w FROM paragraphs),
tokens AS (
  SELECT doc, line, i - 1 AS ord, lang, source, w[i] AS t,
         CASE WHEN length(w[i]) % 5 = 0 THEN '' ELSE ['subject','predicate','object','attributive','adverbial','complement','topic','function'][length(w[i]) % 8 + 1] END AS g
  FROM (SELECT *, unnest(generate_series(1, len(w))) AS i FROM words))"""
