"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontaminate, line_dedup, packing, periodic, quality, secret_scan, set_join, sharding, simhash, token_counts, topk, url_filter
from .tokens import public_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_topk(spark, sf):
    """The 20 best matches of every twentieth vector among all others."""
    vectors = topk.quantised(table(spark, sf, "embeddings"), "vec_id", "embedding", 64.0)
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)


ORACLE["op1_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.codes, c.codes), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""


@query
def op3_decontamination(spark, sf):
    """Documents that hold benchmark items."""
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op4_sharding(spark, sf):
    """Documents in 16 shards of equal row counts."""
    placed = sharding.balanced_shards(table(spark, sf, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op5_token_counts(spark, sf):
    """Tokens of every document, with a cache that starts empty."""
    docs = table(spark, sf, "documents")
    return token_counts.count_tokens(docs, token_counts.new_cache(docs), public_file("byte_bpe_50k.json"), 1024)


@query
def op7_best_fit_packing(spark, sf):
    """Documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf, "documents"), public_file("byte_bpe_50k.json"), 2048, 0)


@query
def op8_simhash(spark, sf):
    """Fingerprints and components of all documents."""
    found = simhash.near_duplicates(table(spark, sf, "documents"), max_bits=2, words=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_secret_scan(spark, sf):
    """Secrets of all documents."""
    docs = table(spark, sf, "documents")
    return secret_scan.scan(docs, secret_scan.infer_formats(docs))


@query
def op10_line_dedup(spark, sf):
    """Repeated passages of all documents, but for the earliest of each."""
    return line_dedup.repeated_passages(table(spark, sf, "documents"), "sentence", 4, 25)


@query
def op2_quality(spark, sf):
    """Quality of all documents, learnt outside the held-out fold."""
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"), 0.3)


@query
def op11_periodic_runs(spark, sf):
    """Periodic runs of all documents, a tenth of them with repetitions laid over."""
    found = periodic.periodic_runs(periodic.planted(table(spark, sf, "documents")))
    longer = lambda best, x: F.when(  # noqa: E731  the earlier run stays where length / period is the same
        best["period"].isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x
    ).otherwise(best)
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return found.withColumn("best", F.aggregate("runs", none, longer)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_centroids(spark, sf):
    """Vectors in 40 clusters after five rounds."""
    vectors = centroids.quantised(table(spark, sf, "embeddings"), "vec_id", "embedding", 256.0, 64)
    return centroids.with_inertia(*centroids.clusters(vectors, 40, 5, "2"))


# A round: every vector's nearest centroid, then centroids at the floor of their vectors' mean.
_ROUND = """, a{n} AS MATERIALIZED (
  SELECT row, min(struct_pack(d := d, c := c)) AS best FROM (
    SELECT v.row, c.c, list_sum(list_transform(list_zip(v.codes, c.codes), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v, c{n} c) GROUP BY row
), c{m} AS MATERIALIZED (
  SELECT c.c, coalesce(moved.codes, c.codes) AS codes FROM c{n} c LEFT JOIN (
    SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS codes FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n FROM (
        SELECT a.best.c AS c, unnest(v.codes) AS x, generate_subscripts(v.codes, 1) AS i FROM a{n} a JOIN v USING (row))
      GROUP BY c, i) GROUP BY c) moved ON moved.c = c.c
)"""
ORACLE["op12_centroids"] = (
    """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), codes) - 1 AS INT) AS c, codes
  FROM v WHERE vec_id IS NOT NULL ORDER BY c LIMIT 40
)"""
    + "".join(_ROUND.format(n=n, m=n + 1) for n in range(6))
    + """
SELECT vec_id, best.c AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c5.codes, ',')) AS centroid_sha256
FROM a5 JOIN v USING (row) JOIN c5 ON c5.c = best.c
"""
)


@query
def op13_jaccard_join(spark, sf):
    """Components of documents whose 4-word shingles overlap by 85 % or more."""
    found = set_join.jaccard_components(table(spark, sf, "documents"), words=4, percent=85)
    return found.select("doc_id", "n_shingles", "component_id")


# Times of captures and list entries, in seconds of one year, from digests: the tables have none.
_YEAR = 31_536_000


def _moment(text):
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % _YEAR


def _list_entries(pages):
    """Dated entries for every host, parent domain and first path segment of the pages."""
    host = url_filter.host_of(F.col("url"))
    first = F.regexp_extract("url", r"^[a-z]+://[^/]*/([^/?#]+)", 1)
    named = pages.select(host.alias("host"), first.alias("first")).distinct()
    patterns = named.select(F.explode(F.array(
        F.struct(F.lit("hosts").alias("list_name"), F.col("host").alias("pattern")),
        F.struct(F.lit("domains").alias("list_name"), F.regexp_replace("host", r"^[^.]*\.", "").alias("pattern")),
        F.struct(F.lit("paths").alias("list_name"), F.concat_ws("/", "host", "first").alias("pattern")),
    )).alias("e")).select("e.*").distinct()
    # Three turns: added, removed, added again, each later than the one before.
    turns = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(n).alias("n")) for n, a in enumerate(["add", "remove", "add"])])
    dated = patterns.withColumn("turn", F.explode(turns))
    start = _moment(F.concat(F.lit("from "), "list_name", F.lit(" "), "pattern"))
    step = _moment(F.concat(F.lit("step "), "list_name", F.lit(" "), "pattern"))
    return dated.select(
        "list_name", "pattern", F.col("turn.action").alias("action"),
        (start + F.col("turn.n") * (F.floor(step / F.lit(4)) + 1)).cast("long").alias("at"),
    )


@query
def op6_url_filters(spark, sf):
    """Every page's lists at its fetch time."""
    pages = table(spark, sf, "pages")
    captures = pages.select(
        "page_id", "url", _moment(F.concat(F.lit("fetch "), F.col("page_id").cast("string"))).alias("fetched_at")
    )
    marked = url_filter.evaluate(captures, _list_entries(pages))
    return marked.select(
        "page_id", "url", "fetched_at", F.array_join("lists", ",").alias("lists"), "n_entries",
        (F.col("n_entries") > 0).alias("blocked"),
    )


def _sql_moment(text):
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {_YEAR})"


ORACLE["op6_url_filters"] = f"""
WITH p AS (
  SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:@]*)', 1)) AS host,
         regexp_extract(url, '^[a-z]+://[^/]*/([^/?#]+)', 1) AS first,
         {_sql_moment("'fetch ' || page_id")} AS fetched_at
  FROM pages
), e AS (
  SELECT DISTINCT list_name, pattern FROM (
    SELECT 'hosts' AS list_name, host AS pattern FROM p
    UNION ALL SELECT 'domains', regexp_replace(host, '^[^.]*\\.', '') FROM p
    UNION ALL SELECT 'paths', host || '/' || first FROM p)
), d AS (
  SELECT list_name, pattern, {_sql_moment("'from ' || list_name || ' ' || pattern")} AS a,
         {_sql_moment("'step ' || list_name || ' ' || pattern")} // 4 + 1 AS s FROM e
), i AS (
  SELECT list_name, pattern, a AS f, a + s AS t FROM d UNION ALL SELECT list_name, pattern, a + 2 * s, NULL FROM d
), m AS (
  SELECT p.page_id, list_name FROM p JOIN i
  ON (pattern = host OR ends_with(host, '.' || pattern) OR pattern = host || '/' || first)
     AND fetched_at >= f AND (t IS NULL OR fetched_at < t)
)
SELECT p.page_id, any_value(url) AS url, any_value(fetched_at) AS fetched_at,
       coalesce(string_agg(DISTINCT list_name, ',' ORDER BY list_name), '') AS lists,
       count(list_name) AS n_entries, count(list_name) > 0 AS blocked
FROM p LEFT JOIN m USING (page_id) GROUP BY p.page_id
"""

# Words with the white space behind them, cut where one ends a sentence or a line break follows.
ORACLE["op10_line_dedup"] = """
WITH w AS (
  SELECT doc_id, piece, n, rtrim(piece, chr(32) || chr(9) || chr(10) || chr(13)) AS word FROM (
    SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS n FROM (
      SELECT doc_id, regexp_extract_all(text, '^\\s+|\\S+\\s*') AS pieces FROM documents))
), o AS (
  SELECT *, coalesce(sum(length(piece)) OVER earlier, 0) AS place,
    coalesce(sum(CAST(regexp_matches(word, '[.!?]$') OR contains(piece, chr(10)) AS INT)) OVER earlier, 0) AS sentence
  FROM w WINDOW earlier AS (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), s AS (
  SELECT doc_id, sentence, min(place) AS start, max(place + length(word)) AS "end", min(n) AS first_word, max(n) + 1 AS last_word,
    string_agg(lower(word), ' ' ORDER BY n) AS unit
  FROM o WHERE word <> '' GROUP BY doc_id, sentence HAVING count(*) >= 4
), l AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sentence) AS k, first_value(doc_id) OVER u AS kept,
    row_number() OVER u AS turn FROM s WINDOW u AS (PARTITION BY unit ORDER BY doc_id, sentence)
), r AS (
  SELECT *, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM l WHERE turn > 1
)
SELECT doc_id, CAST(min(start) AS INT) AS start, CAST(max("end") AS INT) AS "end",
  CAST(max(last_word) - min(first_word) AS INT) AS words, min(kept) AS kept_doc_id
FROM r GROUP BY doc_id, run HAVING max(last_word) - min(first_word) >= 25
"""
