"""SimHash near-duplicates through deletion-variant signatures.

A fingerprint is cut into so few segments that, of two fingerprints within the
bit distance, one segment differs by at most one bit (3 segments for 4 bits).
Every segment is indexed by its value and by its one-wildcard variants (one
bit deleted, and its place). Equality joins on those keys find every pair;
the full distance verifies it.

Only classes are asked for, so dense cells (segment values that many
fingerprints share) need not give all their pairs: they are cut into square
tiles, each compared in one numpy step that returns a spanning star per local
class. Every fingerprint of a dense cell and of its one-bit neighbours is in
those tiles, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .staging import discard, free_name, staged

BITS = 64
#: Segment values with more fingerprints than this are compared in tiles.
DENSE = 64
#: Fingerprints on each side of a tile.
TILE = 1024
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _fingerprint(text: str | None, width: int, seed: int) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    spans = zip(starts[:n].tolist(), ends[len(ends) - n :].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        block = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(">u8")[0])


def simhash(text: Column, width: int = 4, seed: int = 42) -> Column:
    """The 64-bit fingerprint (as a signed long) of a text column.

    A-Z is lower-cased; words are runs without ASCII white space; shingles are
    ``width`` words joined by a space, repeats included (fewer words: the
    whole sequence). A bit is 1 where over half of the shingles' XXH64 have
    it. A null text, or one without words, has fingerprint 0.
    """

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        out = np.fromiter((_fingerprint(t, width, seed) for t in texts), np.uint64, len(texts))
        return pd.Series(out.view(np.int64))

    return fingerprints(text)


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the segments for a bit distance: with ``k``
    segments, ``2 k - 1`` differing bits leave one with at most one."""
    k = distance // 2 + 1
    cuts = [BITS * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _local_links(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (member, smallest member) of the links between a and b."""
    if not len(a) or not len(b):
        return a[:0], b[:0]
    both = np.unique(np.concatenate([a, b]))
    ia, ib = np.searchsorted(both, a), np.searchsorted(both, b)
    bits = a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]
    near = np.bitwise_count(bits) <= distance
    label = np.arange(len(both))
    while True:
        old = label
        low_a = np.where(near, label[ib][None, :], len(both)).min(axis=1)
        label = label.copy()
        np.minimum.at(label, ia, low_a)
        low_b = np.where(near, label[ia][:, None], len(both)).min(axis=0)
        np.minimum.at(label, ib, low_b)
        label = np.minimum(label, label[label])
        if np.array_equal(label, old):
            break
    moved = label != np.arange(len(both))
    return both[moved], both[label[moved]]


def fingerprint_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``a, b`` whose classes are those of all pairs of distinct
    fingerprints (column ``fp``, long) within ``distance`` bits."""
    cuts = segments(distance)
    value = [F.shiftrightunsigned(F.col("fp"), lo).bitwiseAND(F.lit((1 << w) - 1)) for lo, w in cuts]
    cells = fps.select("fp", F.posexplode(F.array(*value)).alias("seg", "val"))
    width = F.element_at(F.array(*[F.lit(w) for _, w in cuts]), F.col("seg") + 1)
    sizes = cells.groupBy("seg", "val").agg(F.count(F.lit(1)).alias("n"))
    dense = staged(sizes.where(F.col("n") > DENSE).select("seg", "val"), "simhash-dense")
    sparse = cells.join(dense, ["seg", "val"], "left_anti")
    verified = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance

    def key(*parts: Column) -> Column:
        # segment number, place of the wildcard and the other bits in one long
        seg, place, rest = parts
        return F.shiftleft(seg.cast("bigint"), 58) + F.shiftleft(place.cast("bigint"), 52) + rest

    # merge joins of what is exploded: the planner's estimate is that of the rows before, and it
    # would build and broadcast up to 64 rows per fingerprint in the driver
    # the same value: place 63 stands for "no wildcard"
    same = sparse.select("fp", key(F.col("seg"), F.lit(63), F.col("val")).alias("k"))
    equal = same.alias("x").join(same.alias("y").hint("merge"), (F.col("x.k") == F.col("y.k")) & (F.col("x.fp") < F.col("y.fp")) & verified)
    # one bit deleted: a pair differs there, so 0 on one side meets 1 on the other
    wild = sparse.withColumn("place", F.explode(F.sequence(F.lit(0), width - 1)))
    bit = F.expr("shiftrightunsigned(val, place) & 1L")
    wild = wild.select("fp", bit.alias("bit"), key(F.col("seg"), F.col("place"), F.expr("val & ~shiftleft(1L, place)")).alias("k"))
    zero, one = wild.where("bit = 0").select("fp", "k"), wild.where("bit = 1").select("fp", "k")
    apart = zero.alias("x").join(one.alias("y").hint("merge"), (F.col("x.k") == F.col("y.k")) & verified)
    pairs = equal.unionAll(apart).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    # dense cells with their one-bit neighbours, in tiles
    flips = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(F.sequence(F.lit(0), width - 1), lambda p: F.call_function("shiftleft", F.lit(1).cast("bigint"), p)))
    around = dense.select("seg", F.col("val").alias("home"), F.explode(flips).alias("flip"))
    around = around.select("seg", "home", F.col("home").bitwiseXOR(F.col("flip")).alias("val"))
    members = staged(cells.join(around.hint("merge"), ["seg", "val"]).select("seg", "home", "fp"), "simhash-members")
    chunks = members.groupBy("seg", "home").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("chunks"))
    cut = members.join(chunks, ["seg", "home"]).withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    tiles = cut.select("seg", "home", "fp", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    tiles = tiles.select("seg", "home", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "fp")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        i, j = rows["i"].iat[0], rows["j"].iat[0]
        fp, chunk = rows["fp"].to_numpy(np.int64), rows["chunk"].to_numpy()
        left, right = _local_links(fp[chunk == i], fp[chunk == j], distance)
        return pd.DataFrame({"a": left, "b": right})

    return pairs.unionAll(tiles.groupBy("seg", "home", "i", "j").applyInPandas(compare, "a long, b long"))


def near_duplicate_classes(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 4,
    distance: int = 4,
    seed: int = 42,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Every row of ``df`` with its ``columns`` (None: all) plus
    ``fingerprint`` (16 lowercase hex digits) and ``component_id``: the
    smallest id reachable over links of at most ``distance`` differing bits,
    the row itself included.

    Columns of those two names are replaced. Null and empty texts share
    fingerprint 0 and link like any other. A null id counts for nobody: its
    row gets the smallest id of its class, or null where the class has none.
    Repeated rows stay. An empty table gives an empty result.
    """
    kept = [c for c in (columns or df.columns) if c not in ("fingerprint", "component_id")]
    fp, ident = free_name(df, "fp"), free_name(df, "ident")
    rows = [F.col(f"`{c}`") for c in kept]
    mark = simhash(F.col(f"`{text_column}`"), width, seed).alias(fp)
    hashed = staged(df.select(*rows, F.col(f"`{id_column}`").alias(ident), mark), "simhash-rows")
    fps = hashed.groupBy(F.col(fp).alias("fp")).agg(F.min(ident).alias("least"))
    fps = staged(fps, "simhash-fps")
    links = staged(fingerprint_links(fps, distance), "simhash-links")
    roots = connected_components(links, "a", "b")
    named = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(least, "root").select(F.col("fp").alias(fp), "component_id")
    discard(links)
    out = hashed.join(classes, fp).withColumn("fingerprint", F.lpad(F.lower(F.hex(F.col(fp))), 16, "0"))
    return out.select(*rows, "fingerprint", "component_id")


def keep_one_of_each(df: DataFrame, id_column: str = "doc_id", **params) -> DataFrame:
    """One row of each near-duplicate class: the one with the smallest id
    (equal ids: the first by row content; a class without ids keeps its first
    row by content). The columns of ``df`` are unchanged."""
    classed = near_duplicate_classes(df, id_column, **params)
    cols = df.columns
    rows = classed.select("component_id", "fingerprint", F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"))
    ident = F.col("row").getField(id_column)
    # only rows that carry the class id (or have none) can stay
    can = rows.where(ident.eqNullSafe(F.col("component_id")))
    mark = F.when(F.col("component_id").isNull(), F.col("fingerprint"))
    best = can.groupBy("component_id", mark.alias("m")).agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return best.select("row.*")
