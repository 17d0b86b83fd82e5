"""Queries on progress: labels are results of documents (quality 1 valid, 0 stale), events a log of attempts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexalign.operators import artifacts as A
from lexalign.operators import progress as P
from lexalign.plans.adapt import registry, table
from lexalign.streaming import stalls as S

QUERIES, SQL, query = registry()


def _status(spark, sf_dir):
    """Documents as a manifest, labels as results; a label of bad quality has other paragraphs."""
    manifest = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("ord"), F.col("doc_id").cast("string").alias("chunk_id"), F.array(F.col("doc_id").cast("string")).alias("para_ids"), F.col("n_chars").alias("chars"), F.sha2("text", 256).alias("sha"))
    results = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("chunk_id"), F.when(F.col("quality") == 1, F.array(F.col("doc_id").cast("string"))).otherwise(F.array(F.lit("x"))).alias("para_ids"))
    return P.status(manifest, results)


_STATUS = "s AS (SELECT source, d.doc_id AS ord, CAST(d.doc_id AS VARCHAR) AS chunk_id, n_chars AS chars, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 1 THEN 'valid' ELSE 'stale' END AS status FROM documents d LEFT JOIN labels l USING (doc_id))"


@query(f"WITH {_STATUS} SELECT source, chunk_id, status FROM s")
def manifest_status(spark, sf_dir):
    return _status(spark, sf_dir).select("source", "chunk_id", "status")


@query(f"""
WITH {_STATUS}
SELECT source, CAST(count(*) AS BIGINT) AS manifest_chunks, CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid_chunks, CAST(count(*) FILTER (WHERE status = 'missing') AS BIGINT) AS missing_chunks, CAST(count(*) FILTER (WHERE status = 'stale') AS BIGINT) AS stale_chunks,
  CAST(coalesce(sum(chars) FILTER (WHERE status = 'valid'), 0) AS BIGINT) AS covered_chars, coalesce(arg_max(chunk_id, ord) FILTER (WHERE status = 'valid'), '') AS last_valid, coalesce(arg_min(chunk_id, ord) FILTER (WHERE status = 'missing'), '') AS first_missing,
  coalesce(arg_min(chunk_id, ord) FILTER (WHERE status = 'stale'), '') AS first_stale, bool_and(status = 'valid') AS complete
FROM s GROUP BY source""")
def progress_summary(spark, sf_dir):
    out = P.progress(_status(spark, sf_dir), ["source"])
    return out.withColumn("complete", P.complete(F.col("manifest_chunks"), F.col("valid_chunks"), F.col("missing_chunks"), F.col("stale_chunks")))


@query(f"""
WITH {_STATUS},
f AS (SELECT s.*, row_number() OVER (PARTITION BY source ORDER BY ord) AS place, coalesce(toxic = 1, false) AS failed FROM s LEFT JOIN labels ON labels.doc_id = s.ord)
SELECT source, CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) AS valid, CAST(count(*) FILTER (WHERE failed AND status <> 'valid') AS BIGINT) AS failed, CAST(min(place) FILTER (WHERE status <> 'valid') AS BIGINT) AS first_missing,
  CAST(greatest(0, count(*) - count(*) FILTER (WHERE status = 'valid') - count(*) FILTER (WHERE failed AND status <> 'valid')) AS BIGINT) AS pending FROM f GROUP BY source""")
def book_status(spark, sf_dir):
    toxic = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"), (F.col("toxic") == 1).alias("failed"))
    rows = _status(spark, sf_dir).join(toxic, "ord", "left").select("source", "ord", (F.col("status") == "valid").alias("valid"), F.coalesce("failed", F.lit(False)).alias("failed"))
    return P.book_status(rows, ["source"])


def _states(spark, sf_dir):
    """Valid, a good candidate (unlabelled, odd) or one that blocks."""
    rows = _status(spark, sf_dir)
    state = F.when(F.col("status") == "valid", "valid").when((F.col("status") == "missing") & (F.col("ord") % 5 != 0), "candidate").when(F.col("status") == "stale", "invalid").otherwise("missing")
    return rows.withColumn("state", state)


_STATES = _STATUS + ", t AS (SELECT *, CASE WHEN status = 'valid' THEN 'valid' WHEN status = 'missing' AND ord % 5 <> 0 THEN 'candidate' WHEN status = 'stale' THEN 'invalid' ELSE 'missing' END AS state FROM s)"


@query(f"""
WITH {_STATES},
b AS (SELECT *, sum(CASE WHEN state IN ('valid', 'candidate') THEN 0 ELSE 1 END) OVER w AS blocked, sum(CASE WHEN state = 'candidate' THEN 1 ELSE 0 END) OVER w AS taken FROM t WINDOW w AS (PARTITION BY source ORDER BY ord))
SELECT source, chunk_id, state, state = 'candidate' AND blocked = 0 AND taken <= 3 AS promoted FROM b""")
def contiguous_promotion(spark, sf_dir):
    """Candidates promoted in order up to the first gap, three at most."""
    return P.promotions(_states(spark, sf_dir), ["source"], 3).select("source", "chunk_id", "state", "promoted")


@query(f"WITH {_STATES} SELECT source, arg_min(chunk_id, ord) FILTER (WHERE state NOT IN ('valid', 'candidate')) AS waiting_for FROM t GROUP BY source")
def waiting_for(spark, sf_dir):
    return P.waiting_for(_states(spark, sf_dir), ["source"])


@query("SELECT doc_id, quality, toxic FROM labels ANTI JOIN (SELECT doc_id FROM documents WHERE lang = 'en') USING (doc_id)")
def stray_anti_join(spark, sf_dir):
    return P.strays(table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").where("lang = 'en'"), "doc_id").select("doc_id", "quality", "toxic")


@query("""
SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND doc_id IN (SELECT conv_id FROM conversations)""")
def claimable_semi_anti(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    needed = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"))
    return P.claimable(table(spark, sf_dir, "documents").select("doc_id", "source"), [labels.where("quality = 1"), labels.where("toxic = 1")], "doc_id", needed)


@query("""
SELECT event_type, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE value > 5) AS BIGINT) AS over_5, CAST(count(*) FILTER (WHERE value > 20) AS BIGINT) AS over_20, CAST(count(*) FILTER (WHERE value > 50) AS BIGINT) AS over_50,
  CAST(count(*) FILTER (WHERE value > 100) AS BIGINT) AS over_100, max(value) AS most, arg_max(CAST(user_id AS VARCHAR), struct_pack(v := value, l := CAST(user_id AS VARCHAR))) AS worst FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def overflow_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "events").where("value IS NOT NULL").select("event_type", "value", F.col("user_id").cast("string").alias("log"))
    return P.overflows(rows, ["event_type"])


@query("""
SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS api_error, CAST(sum(CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END) AS BIGINT) AS retry FROM events GROUP BY user_id""")
def event_counters(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("text"))
    return P.counters(rows, ["user_id"], {"ok": ["purchase"], "api_error": ["error"], "retry": ["view", "click"]})


@query("""
WITH h AS (SELECT user_id, max(value) AS total, count(*) FILTER (WHERE event_type = 'purchase') AS accepted, count(*) FILTER (WHERE event_type = 'view') AS rejected, count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'click') AS claims, min(event_id) AS first_id, max(ts) AS latest FROM events GROUP BY user_id)
SELECT user_id, CAST(accepted AS BIGINT) AS accepted, CAST(rejected AS BIGINT) AS rejected, CAST(failed AS BIGINT) AS failed, CAST(claims AS BIGINT) AS claims, first_id, strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest,
  CASE WHEN total > 0 AND accepted >= total THEN 'complete' WHEN failed > 0 THEN 'needs_repair' WHEN claims = 0 THEN 'stopped' ELSE 'running' END AS state FROM h""")
def health_snapshot(spark, sf_dir):
    states = F.when(F.col("event_type") == "purchase", "accepted").when(F.col("event_type") == "view", "rejected").when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "claimed")
    rows = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("id"), states.alias("state"), "ts", F.col("value").alias("total"))
    return P.health(rows, ["user_id"]).select("user_id", "accepted", "rejected", "failed", "claims", "first_id", F.date_format("latest", "yyyy-MM-dd HH:mm:ss").alias("latest"), "state")


@query("""
WITH o AS (SELECT user_id, event_type, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord FROM events),
c AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER (PARTITION BY user_id ORDER BY ord) THEN 0 ELSE 1 END AS new FROM o),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ord) AS island FROM c)
SELECT user_id, CAST(island AS BIGINT) AS island, event_type, CAST(count(*) AS BIGINT) AS n, round(epoch(max(ts)) - epoch(min(ts)), 3) AS seconds FROM i GROUP BY 1, 2, 3""")
def stall_islands(spark, sf_dir):
    from pyspark.sql import Window as W

    rows = table(spark, sf_dir, "events").withColumn("ord", F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))).withColumn("ts", F.col("ts").cast("timestamp"))
    return P.stalls(rows, ["user_id"], ["event_type"], "ts").select("user_id", "island", "event_type", "n", F.round("seconds", 3).alias("seconds"))


def _daily(spark, sf_dir):
    from pyspark.sql import Window as W

    days = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("c"))
    order = W.partitionBy("event_type").orderBy("day")
    return days.select("event_type", F.row_number().over(order).alias("ord"), (F.unix_date("day") * 86400).alias("at"), F.sum("c").over(order.rowsBetween(W.unboundedPreceding, 0)).alias("reviewed"), F.when(F.row_number().over(W.partitionBy("event_type").orderBy(F.desc("day"))) == 1, 0).otherwise(1).alias("pending"))


@query("""
WITH RECURSIVE d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS c FROM events GROUP BY 1, 2),
x AS (SELECT event_type, row_number() OVER w AS ord, CAST(epoch(CAST(day AS TIMESTAMP)) AS DOUBLE) AS moment, CAST(sum(c) OVER w AS BIGINT) AS reviewed, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY day DESC) = 1 THEN 0 ELSE 1 END AS pending FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)),
f AS (
  SELECT event_type, ord, reviewed > 0 AS fires, CASE WHEN reviewed > 0 THEN reviewed ELSE 0 END AS done, CASE WHEN reviewed > 0 THEN moment ELSE 0.0 END AS last FROM x WHERE ord = 1
  UNION ALL
  SELECT x.event_type, x.ord, go, CASE WHEN go THEN x.reviewed ELSE f.done END, CASE WHEN go THEN x.moment ELSE f.last END
  FROM f JOIN x ON x.event_type = f.event_type AND x.ord = f.ord + 1, LATERAL (SELECT x.reviewed > 0 AND x.reviewed - f.done > 0 AND (x.reviewed - f.done >= 50 OR x.pending = 0 OR f.last <= 0 OR x.moment - f.last >= 864000) AS go))
SELECT event_type, ord, fires FROM f""")
def compile_trigger(spark, sf_dir):
    return P.triggers(_daily(spark, sf_dir), ["event_type"], 50, 864_000)


@query("""
SELECT user_id, event_id, event_type FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_attempt(spark, sf_dir):
    return P.latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error").select("user_id", "event_id", "event_type")


@query("""
WITH q AS (SELECT c_custkey AS ord, c_name AS id, c_acctbal < 0 AS complete, c_custkey % 7 = 0 AS active FROM customer),
p AS (SELECT *, sum(CASE WHEN NOT complete AND NOT active THEN 1 ELSE 0 END) OVER (ORDER BY ord) AS place, count(*) FILTER (WHERE active AND NOT complete) OVER () AS running FROM q)
SELECT id, CASE WHEN complete THEN 'skip' WHEN active THEN 'active' WHEN place + running <= 300 THEN 'start' ELSE 'defer' END AS decision FROM p""")
def queue_admission(spark, sf_dir):
    queue = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("id"), (F.col("c_acctbal") < 0).alias("complete"), (F.col("c_custkey") % 7 == 0).alias("active"))
    return P.admission(queue, 300).select("id", "decision")


@query("""
WITH t AS (SELECT doc_id AS id, CAST(doc_id % 2 AS INTEGER) AS version, sha256(text) AS sha FROM documents), d AS (SELECT doc_id AS id, 1 AS version, sha256(text) AS sha FROM documents SEMI JOIN labels USING (doc_id))
SELECT id, version, sha FROM t ANTI JOIN d USING (id, version, sha)""")
def skip_unchanged(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tasks = docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 2).cast("int").alias("version"), F.sha2("text", 256).alias("sha"))
    done = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("id"), F.lit(1).alias("version"), F.sha2("text", 256).alias("sha"))
    return P.unchanged(tasks, done).select("id", "version", "sha")


_PATHS = [(b, d, v, f"T{b}", f"/{b}/{d}/{v}/T{b}.pdf") for b, d, v in (("b1", "zh-main", "color"), ("b1", "en-main", "color"), ("b1", "zh-main", "bw"), ("b2", "en-main", "bw"), ("b3", "ja-main", "bw"), ("b3", "en-main", "color"), ("b4", "zh-main", "bw"))]


@query(f"""
WITH i(book_id, direction, variant, title, path) AS (VALUES {", ".join(map(str, _PATHS))})
SELECT book_id, direction, variant, path FROM i QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY CASE WHEN direction = 'zh-main' AND variant = 'color' THEN 0 ELSE 1 END, CASE WHEN variant = 'color' THEN 0 ELSE 2 END, CASE WHEN direction = 'zh-main' THEN 0 ELSE 1 END, direction, variant, title) = 1""")
def edition_pick(spark, sf_dir):
    items = spark.createDataFrame(_PATHS, "book_id string, direction string, variant string, title string, path string")
    return A.editions(items, "zh-main", "color").select("book_id", "direction", "variant", "path")


@query()
def stream_stall(spark, sf_dir):
    """Spans of one event type for each user, from a stream of the events; tested against the batch form."""
    from lexalign.streaming.run import drained

    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")  # a pattern, as the table may be one file
    return drained(spark, S.stalls(events, "user_id", "event_type"), "append")
