"""The registered queries of this subpackage: thin calls of its operators over
whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, centroids, chat, embeddings, fingerprints, lm, mixing, pii, sharding, simhash, tokens, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def tokenizer_path(name: str) -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digest(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_documents(documents, _table(spark, sf_dir, "labels"), threshold=0.3)
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_classes(_table(spark, sf_dir, "documents"), width=4, distance=4, columns=["doc_id"])


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # the contract's conversation -1, whose texts look like control strings
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat.conversation_digest(given.unionByName(extra))


def op8_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=16)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"), k=16, rounds=3, seed=1, dim=64, scale=64.0)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), part_column="source")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return tokens.token_digest(tokens.stored_tokens(documents, tokenizer_path("byte_bpe_50k.json"), end_id=2))


def queries() -> dict[str, Query]:
    return {
        "op1_embedding_near_dedup": op1_embedding_near_dedup,
        "op2_pii_surrogates": op2_pii_surrogates,
        "op3_bpe_encoding": op3_bpe_encoding,
        "op4_toxicity": op4_toxicity,
        "op5_source_mixing": op5_source_mixing,
        "op6_simhash_near_dedup": op6_simhash_near_dedup,
        "op7_chat_formatting": op7_chat_formatting,
        "op8_imatch_fingerprints": op8_imatch_fingerprints,
        "op9_lm_scoring": op9_lm_scoring,
        "op10_sharding": op10_sharding,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_filter_audit": op12_filter_audit,
        "op13_token_files": op13_token_files,
    }


# Vectors that can link, their links, and what links reach. Where exact cosines
# over all pairs of a label are affordable (small tables) this is the whole
# contract of op1.
_OP1_SQL = """
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
lowest AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, least(v.vec_id, coalesce(l.m, v.vec_id)) AS component_id,
       v.vec_id = least(v.vec_id, coalesce(l.m, v.vec_id)) AS kept
FROM embeddings v LEFT JOIN counted c ON c.a = v.vec_id LEFT JOIN lowest l ON l.a = v.vec_id
"""


def _op11_sql(k: int = 16, rounds: int = 3) -> str:
    """Each assignment measures every vector against every centroid. Exact
    while components times 64 stay far below 2 ** 24, as in the given tables."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
scored{r} AS (
  SELECT v.vec_id, v.q, c.c, list_inner_product(v.q, v.q) - 2 * list_inner_product(v.q, c.q) + list_inner_product(c.q, c.q) AS d
  FROM kept v CROSS JOIN centroid{r} c),
found{r} AS MATERIALIZED (
  SELECT vec_id, q, c, d FROM scored{r} QUALIFY row_number() OVER (PARTITION BY vec_id, q ORDER BY d, c) = 1)""")
        if r < rounds:
            steps.append(f"""
parts{r} AS (
  SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM found{r}) GROUP BY c, i),
moved{r} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS q FROM parts{r} GROUP BY c),
centroid{r + 1} AS MATERIALIZED (
  SELECT o.c, coalesce(m.q, o.q) AS q FROM centroid{r} o LEFT JOIN moved{r} m ON m.c = o.c)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
centroid0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS c, q FROM kept
  WHERE vec_id IS NOT NULL QUALIFY c < {k}),{",".join(steps)}
SELECT f.vec_id, CAST(f.c AS INTEGER) AS cluster, CAST(f.d AS BIGINT) AS distance,
       CAST(sum(f.d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN z.q], ',')) AS centroid_sha256
FROM found{rounds} f JOIN centroid{rounds} z ON z.c = f.c
"""


# Every order's filters applied to the documents of each part, told apart by
# what they fail.
_OP12_SQL = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
firsts AS (SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text),
words AS (SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
failed AS MATERIALIZED (
  SELECT d.doc_id, d.part,
         CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(d.text, '[^A-Z]+', '', 'g')) > 5 * len(d.text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN d.doc_id > f.first_id THEN 'E' ELSE '' END AS fails
  FROM words d JOIN firsts f ON f.text = d.text),
known AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
counted AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, sum(coalesce(k.good, 0)) AS good, sum(coalesce(k.toxic, 0)) AS toxic
  FROM failed f LEFT JOIN known k ON k.doc_id = f.doc_id GROUP BY part, fails),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l) WHERE NOT contains(o, l)),
steps AS (
  SELECT o, s AS step, o[s] AS f, CASE WHEN s = 1 THEN '-' ELSE o[1:s - 1] END AS before
  FROM orders, range(1, 6) r(s) WHERE len(o) = 5),
done AS MATERIALIZED (
  SELECT c.part, s.o, s.step, s.f,
         sum(CASE WHEN NOT contains(fails, f) AND NOT regexp_matches(fails, '[' || before || ']') THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, f) AND NOT regexp_matches(fails, '[' || before || ']') THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, f) AND regexp_matches(fails, '[' || before || ']') THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, f) AND NOT regexp_matches(fails, '[' || before || ']') THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, f) AND NOT regexp_matches(fails, '[' || before || ']') THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted c CROSS JOIN steps s GROUP BY c.part, s.o, s.step, s.f)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM done
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_near_dedup": _OP1_SQL, "op11_centroid_clustering": _op11_sql(), "op12_filter_audit": _OP12_SQL}
