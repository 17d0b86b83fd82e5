"""Manifests against results: status, progress, promotion, attempts, stalls and triggers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexalign.functions import text as X


def status(manifest: DataFrame, results: DataFrame) -> DataFrame:
    """Manifest (…, chunk_id, para_ids) with ``status``: missing without a result, stale if the result's paragraphs or their
    order differ, else valid."""
    got = results.select("chunk_id", F.col("para_ids").alias("_got"), F.lit(True).alias("_there"))
    rows = manifest.join(got, "chunk_id", "left")
    state = F.when(F.col("_there").isNull(), "missing").when(F.col("_got").eqNullSafe(F.col("para_ids")), "valid").otherwise("stale")
    return rows.withColumn("status", state).drop("_got", "_there")


def progress(rows: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each book of a status table (keys, ord, chunk_id, status, chars)."""
    is_ = lambda s: F.col("status") == s
    first = lambda s: F.min_by(F.when(is_(s), F.col("chunk_id")), F.when(is_(s), F.col("ord")))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("manifest_chunks"), F.count_if(is_("valid")).alias("valid_chunks"), F.count_if(is_("missing")).alias("missing_chunks"), F.count_if(is_("stale")).alias("stale_chunks"),
        F.coalesce(F.sum(F.when(is_("valid"), F.col("chars"))), F.lit(0)).cast("long").alias("covered_chars"),
        F.coalesce(F.max_by(F.when(is_("valid"), F.col("chunk_id")), F.when(is_("valid"), F.col("ord"))), F.lit("")).alias("last_valid"),
        F.coalesce(first("missing"), F.lit("")).alias("first_missing"), F.coalesce(first("stale"), F.lit("")).alias("first_stale"),
    )


def complete(total: Column, valid: Column, missing: Column, stale: Column) -> Column:
    return (total > 0) & (total == valid) & (missing == 0) & (stale == 0)


def book_status(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, total, valid, failed, pending, first_missing) for (keys, ord, valid, failed); a chunk that is valid by now isn't
    failed, and ``first_missing`` counts from 1."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy("ord"))
    rows = rows.withColumn("_place", place).withColumn("_failed", F.col("failed") & ~F.col("valid"))
    out = rows.groupBy(*keys).agg(F.count("*").alias("total"), F.count_if("valid").alias("valid"), F.count_if("_failed").alias("failed"), F.min(F.when(~F.col("valid"), F.col("_place"))).cast("long").alias("first_missing"))
    return out.withColumn("pending", F.greatest(F.lit(0), F.col("total") - F.col("valid") - F.col("failed")))


def promotions(rows: DataFrame, keys: list[str], most: int = 0) -> DataFrame:
    """Rows (keys, ord, state) with ``promoted``: candidates in order up to the first that is neither valid already nor a good
    candidate, and ``most`` of them at most."""
    order = W.partitionBy(*keys).orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    blocked = F.sum(F.when(~F.col("state").isin("valid", "candidate"), 1).otherwise(0)).over(order)
    taken = F.sum(F.when(F.col("state") == "candidate", 1).otherwise(0)).over(order)
    good = (F.col("state") == "candidate") & (F.col("_blocked") == 0)
    rows = rows.withColumn("_blocked", blocked).withColumn("_taken", taken)
    return rows.withColumn("promoted", good & (F.col("_taken") <= most) if most else good).drop("_blocked", "_taken")


def waiting_for(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, waiting_for): the first chunk that holds up the promotion."""
    blocker = ~F.col("state").isin("valid", "candidate")
    return rows.groupBy(*keys).agg(F.min_by(F.when(blocker, F.col("chunk_id")), F.when(blocker, F.col("ord"))).alias("waiting_for"))


def strays(candidates: DataFrame, sources: DataFrame, key: str) -> DataFrame:
    return candidates.join(sources.select(key), key, "left_anti")


def claimable(sources: DataFrame, done: list[DataFrame], key: str, needed: DataFrame | None = None) -> DataFrame:
    """Sources that no table of ``done`` has, and that ``needed`` has."""
    for table in done:
        sources = sources.join(table.select(key).distinct(), key, "left_anti")
    return sources if needed is None else sources.join(needed.select(key).distinct(), key, "left_semi")


def latest(rows: DataFrame, keys: list[str], by: list[str], only: Column | None = None) -> DataFrame:
    """The last row of each key by ``by`` among those that ``only`` allows."""
    rows = rows if only is None else rows.where(only)
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*[F.desc(c) for c in by]))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def stale_claims(claims: DataFrame, now: Column, ttl: int, alive: Column | None = None) -> DataFrame:
    """Claims older than ``ttl`` seconds, or without a living owner for longer than half a minute."""
    age = now.cast("double") - F.col("claimed_at").cast("double")
    limit = F.lit(ttl) if alive is None else F.when(alive, F.lit(ttl)).otherwise(F.least(F.lit(30), F.lit(ttl)))
    return claims.where(age > limit)


def stalls(rows: DataFrame, keys: list[str], marker: list[str], ts: str) -> DataFrame:
    """(keys, island, marker, since, until, n, seconds): spans over which a marker doesn't change."""
    order = W.partitionBy(*keys).orderBy("ord")
    changed = ~F.coalesce(F.struct(*marker) == F.lag(F.struct(*marker)).over(order), F.lit(False))
    rows = rows.withColumn("island", F.sum(changed.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    out = rows.groupBy(*keys, "island", *marker).agg(F.min(ts).alias("since"), F.max(ts).alias("until"), F.count("*").alias("n"))
    return out.withColumn("seconds", F.col("until").cast("double") - F.col("since").cast("double"))


def triggers(rows: DataFrame, keys: list[str], least: int, longest: float) -> DataFrame:
    """Rows (keys, ord, at, reviewed, pending) with ``fires``: something new since the last firing, and enough of it, nothing
    left to do, no firing before, or too long since. A fold over each key's checks, as each firing moves the next."""
    checks = F.array_sort(F.collect_list(F.struct("ord", "at", "reviewed", "pending")))
    zero = F.struct(F.lit(0).cast("long").alias("done"), F.lit(0.0).alias("last"), F.array().cast("array<struct<ord:bigint,fires:boolean>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        delta = x["reviewed"] - acc["done"]
        fires = (x["reviewed"] > 0) & (delta > 0) & ((delta >= least) | (x["pending"] == 0) | (acc["last"] <= 0) | (x["at"] - acc["last"] >= longest))
        return F.struct(F.when(fires, x["reviewed"]).otherwise(acc["done"]).alias("done"), F.when(fires, x["at"]).otherwise(acc["last"]).alias("last"), F.concat(acc["out"], F.array(F.struct(x["ord"].alias("ord"), fires.alias("fires")))).alias("out"))

    typed = rows.withColumns({"ord": F.col("ord").cast("long"), "at": F.col("at").cast("double"), "reviewed": F.col("reviewed").cast("long"), "pending": F.col("pending").cast("long")})
    return typed.groupBy(*keys).agg(F.aggregate(checks, zero, step, lambda a: a["out"]).alias("out")).select(*keys, F.explode("out").alias("o")).select(*keys, "o.ord", "o.fires")


def admission(queue: DataFrame, cap: int) -> DataFrame:
    """Queue (ord, id, complete, active) with ``decision``: skip what is complete, run what is active, start others in order
    while fewer than ``cap`` run, and defer the rest. Only the first ``cap`` that could start are put in order."""
    open_ = ~F.col("complete") & ~F.col("active")
    running = queue.agg(F.count_if(F.col("active") & ~F.col("complete"))).scalar()
    first = queue.where(open_).select("ord", "id").orderBy("ord").limit(cap)
    first = first.withColumn("_place", F.row_number().over(W.orderBy("ord"))).where(F.col("_place") + running <= cap)
    rows = queue.join(F.broadcast(first.drop("ord")), "id", "left")
    decision = F.when(F.col("complete"), "skip").when(F.col("active"), "active").when(F.col("_place").isNotNull(), "start").otherwise("defer")
    return rows.withColumn("decision", decision).drop("_place")


def unchanged(tasks: DataFrame, done: DataFrame) -> DataFrame:
    """Tasks (id, version, sha) that have to run: those not done with the same version and content."""
    return tasks.join(done.select("id", "version", "sha").distinct(), ["id", "version", "sha"], "left_anti")


def health(rows: DataFrame, keys: list[str], total: str = "total") -> DataFrame:
    """(keys, accepted, rejected, failed, claims, first_id, latest, state) for items (keys, id, state, ts) and a total."""
    n = lambda s: F.count_if(F.col("state") == s)
    out = rows.groupBy(*keys).agg(F.max(total).alias("total"), n("accepted").alias("accepted"), n("rejected").alias("rejected"), n("failed").alias("failed"), n("claimed").alias("claims"), F.min("id").alias("first_id"), F.max("ts").alias("latest"))
    state = F.when((F.col("total") > 0) & (F.col("accepted") >= F.col("total")), "complete").when(F.col("failed") > 0, "needs_repair").when(F.col("claims") == 0, "stopped").otherwise("running")
    return out.withColumn("state", state)


def usage_limited(c: Column) -> Column:
    return F.lower(X.empty(c)).rlike("usage limit|rate limit|quota exceeded|too many requests")


def counters(logs: DataFrame, keys: list[str], literals: dict[str, list[str]]) -> DataFrame:
    """(keys, counters): how often each literal occurs in all texts."""
    times = lambda words: sum((F.regexp_count(X.empty(F.col("text")), F.lit(r"\Q" + w + r"\E")) for w in words), F.lit(0))
    return logs.groupBy(*keys).agg(*[F.sum(times(words)).cast("long").alias(name) for name, words in literals.items()])


def overflows(values: DataFrame, keys: list[str], steps: tuple[int, ...] = (5, 20, 50, 100)) -> DataFrame:
    """(keys, n, over_…, most, worst) for (keys, value, log)."""
    over = [F.count_if(F.col("value") > s).alias(f"over_{s}") for s in steps]
    return values.groupBy(*keys).agg(F.count("*").alias("n"), *over, F.max("value").alias("most"), F.max_by("log", F.struct("value", "log")).alias("worst"))
