"""Sharding by rendezvous hashing over weighted shards.

Each record key scores every shard with ``-weight / ln(u)``, where ``u`` is a
uniform hash of (key, shard), and goes to the shard with the highest score. A
shard's share is its weight over all weights, and the score of an existing
shard does not depend on how many others there are: one more shard takes rows
only into itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import free_name, uniform

#: Rows of one shard that one window task numbers, on average.
ROWS_PER_RANGE = 20_000
#: Copies of one row that one generated piece holds.
COPIES_PER_PIECE = 10_000


def rendezvous(key: Column, weights: Sequence[float], seed: int = 17) -> Column:
    """The shard (0 to ``len(weights) - 1``) of ``key``; a null key counts as
    one key of its own. Weights must be positive. No shuffle."""
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("shard weights must be positive")
    scored = [
        F.struct((F.lit(-float(w)) / F.ln(uniform(key, i, seed))).alias("score"), F.lit(i).alias("shard"))
        for i, w in enumerate(weights)
    ]
    return F.array_max(F.array(*scored))["shard"]


def number_rows(df: DataFrame, shard: str, slot: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in an order that
    depends on row contents only (so reruns agree).

    A shard is cut into ranges of a content hash. Range counts give each
    range its first number, so no task holds a whole shard. Equal rows are
    counted before the shuffle and given neighbouring numbers. Every column
    must be groupable (no maps).
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    order, many, part, start = (free_name(df, n) for n in ("order_hash", "copies", "range_no", "range_start"))
    total = df.count()
    shards = max(1, df.select(F.approx_count_distinct(F.col(f"`{shard}`"))).first()[0])
    bits = max(0, (total // (shards * ROWS_PER_RANGE)).bit_length())
    rows = (
        df.groupBy(*cols)
        .agg(F.count(F.lit(1)).alias(many))
        .withColumn(order, F.xxhash64(*cols))
        .withColumn(part, F.shiftrightunsigned(F.col(order), 64 - bits).cast("int") if bits else F.lit(0))
    )
    key = F.col(f"`{shard}`")
    before = Window.partitionBy("k").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(key.alias("k"), F.col(part).alias(part))
        .agg(F.sum(many).alias("n"))
        .select("k", F.col(part).alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    )
    inside = Window.partitionBy(key, part).orderBy(order, *cols).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col(start) + F.coalesce(F.sum(many).over(inside), F.lit(0))
    placed = (
        rows.join(starts, key.eqNullSafe(F.col("k")) & (F.col(part) == F.col("p")))
        .select(*cols, first.alias(start), F.col(many))
        .withColumn(part, F.explode(F.sequence(F.lit(0), F.floor((F.col(many) - 1) / COPIES_PER_PIECE))))
    )
    lo = F.col(part) * COPIES_PER_PIECE
    hi = F.least(F.col(many), lo + COPIES_PER_PIECE) - 1
    return placed.select(*cols, F.explode(F.sequence(F.col(start) + lo, F.col(start) + hi)).alias(slot))


def shard_documents(df: DataFrame, shards: int = 16, weights: Sequence[float] | None = None) -> DataFrame:
    """Digest of the shard plan of ``documents``: ``doc_id, size, text_crc32,
    law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text plus 1 (a null text has size 1
    and the CRC of the empty text). The law is ``key``: doc_id and the shard
    count decide; ``grown_shard`` is the shard with one more shard of mean
    weight. A null doc_id is one key; repeated rows share a shard and get
    slots of their own. An empty table gives an empty result.
    """
    weights = list(weights or [1.0] * shards)
    key = F.col("doc_id").cast("string")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = df.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, [*weights, sum(weights) / len(weights)]).alias("grown_shard"),
    )
    return number_rows(rows, "shard").select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
