"""The queries ``opN_<name>`` and ``pipeline``: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.session import table

from . import additive_quality, ball_tree, bpe_transducer, byte_bpe, chat_format, nnls_packing, periodic_runs, prefix_join, secret_ledger, stable_projection, url_filter, whitening, zstd_toxicity

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
TIKTOKEN_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_stable_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stable_projection.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


OP2_SQL = r"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(rh, rp, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
hit AS (
  SELECT page_id, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT u.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM hit WHERE k = 1) h ON u.page_id = h.page_id
"""


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two passes over one ledger: the second finds all its pairs known and joins their findings back."""
    docs, ledger = table(spark, sf_dir, "documents"), secret_ledger.Ledger(spark)
    secret_ledger.extend(docs, ledger)
    found = secret_ledger.scan(docs, ledger)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",").alias("spans"),
    ).withColumn("base_sha256", F.sha2("spans", 256))


#: Runs are taken whole by DuckDB as by Python; ends of earlier parts add up to starts.
OP3_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
r(k, kind, p, least) AS (VALUES
  (0, 'assign', '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 12),
  (1, 'access', '(AKIA[A-Z0-9]+)', 18), (2, 'hex', '([0-9a-f]+)', 16)),
m AS (
  SELECT doc_id, k, kind, least, text, regexp_extract_all(text, p) AS whole, regexp_extract_all(text, p, 1) AS part
  FROM d JOIN r ON regexp_matches(text, p)),
-- What stands between matches is what is left when a text is split at them.
s AS (
  SELECT doc_id, k, kind, least, whole, part, string_split_regex(text, CASE k
    WHEN 0 THEN '(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?(?:[A-Za-z0-9+/_.=-]+)'
    WHEN 1 THEN 'AKIA[A-Z0-9]+' ELSE '[0-9a-f]+' END) AS gaps FROM m),
x AS (
  SELECT doc_id, k, kind, least, unnest(range(1, len(whole) + 1)) AS i, unnest(whole) AS w, unnest(part) AS g, unnest(gaps[1:len(whole)]) AS gap FROM s),
y AS (
  SELECT doc_id, k, kind, least, g, sum(length(gap) + length(w)) OVER (PARTITION BY doc_id, k ORDER BY i) AS e, length(w) AS n FROM x),
f AS (SELECT doc_id, k, kind, (e - n)::BIGINT AS a, e::BIGINT AS e FROM y WHERE length(g) >= least),
t AS (
  SELECT doc_id, count_if(k = 0) AS n_assign, count_if(k = 1) AS n_access, count_if(k = 2) AS n_hex, string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, k) AS spans
  FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id
"""


def op4_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.link_components(table(spark, sf_dir, "documents"), k=4, percent=85)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3])) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
b AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT b.v, r.c FROM r JOIN b ON b.u = r.doc_id WHERE r.c < b.v)
SELECT n.doc_id, any_value(n)::BIGINT AS n_shingles, min(c) AS component_id FROM n JOIN r USING (doc_id) GROUP BY n.doc_id
"""


QUALITY_THRESHOLD, TOXIC_THRESHOLD = 0.7, 0.3


def _judged(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", additive_quality.held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _judged(additive_quality.score(docs, additive_quality.train(docs, table(spark, sf_dir, "labels"))), QUALITY_THRESHOLD)


def op6_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return _judged(zstd_toxicity.score(docs, zstd_toxicity.train(docs, table(spark, sf_dir, "labels"))), TOXIC_THRESHOLD)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(TIKTOKEN_FILE))


PLANTED_ID, PLANTED_TEXT = -7, "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(PLANTED_ID, 0, "user", PLANTED_TEXT), (PLANTED_ID, 1, "assistant", PLANTED_TEXT)], turns.schema)
    out = chat_format.format_chats(turns.unionByName(planted))
    return out.withColumns({"t": chat_format.read_turns(F.col("formatted")), "loss": chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))}).select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP8_SQL = r"""
WITH a AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
b AS (
  SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after
  FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
c AS (
  SELECT *, length(replace(replace(text, '\', '\\'), '<', '\l'))
    + CASE WHEN before = role THEN 6 ELSE 12 + length(replace(replace(role, '\', '\\'), '<', '\l')) END
    + CASE WHEN after = role THEN 0 ELSE 8 END AS n
  FROM b)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""


BPE_FILE = "byte_bpe_50k.json"


def op9_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nnls_packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op10_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP10_SQL = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s)
SELECT query_id, k::INTEGER AS rank, vec_id, score FROM r WHERE k <= 5
"""


def op11_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.digest_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


def with_planted_runs(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a text; a tenth of the documents repeats a part of its own to the end."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), edit=with_planted_runs)
    # Runs come by start, then period, so the first of those with the greatest exponent stays.
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), lambda b, r: F.when(more(b, r), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_stable_projection": op1_stable_projection,
        "op2_url_filter": op2_url_filter,
        "op3_secret_ledger": op3_secret_ledger,
        "op4_prefix_join": op4_prefix_join,
        "op5_additive_quality": op5_additive_quality,
        "op6_zstd_toxicity": op6_zstd_toxicity,
        "op7_byte_bpe": op7_byte_bpe,
        "op8_chat_format": op8_chat_format,
        "op9_nnls_packing": op9_nnls_packing,
        "op10_ball_tree": op10_ball_tree,
        "op11_bpe_transducer": op11_bpe_transducer,
        "op12_whitening": op12_whitening,
        "op13_periodic_runs": op13_periodic_runs,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": OP2_SQL, "op3_secret_ledger": OP3_SQL, "op4_prefix_join": OP4_SQL, "op8_chat_format": OP8_SQL, "op10_ball_tree": OP10_SQL}
