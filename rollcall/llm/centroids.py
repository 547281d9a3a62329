"""Exact Lloyd clustering with heap-ordered bounds.

Vectors are packed once into blocks of a few thousand, in the scan order, so
no vector is ever shuffled. In a block every cluster has a min-heap of its
vectors, keyed by the gap between the distance to the second nearest and to
the own centroid, plus the cluster's drift at that time. When centroids move,
a cluster's drift grows by its own step and the largest step of any other one;
a vector can change its cluster only if the drift has reached its key. So only
such vectors are popped, measured against all centroids and pushed again; the
rest of a heap is not touched. A cluster with a third of all rows has a heap in
each block, and so no large group in any task.

A round returns per block the integer sums of each cluster; Spark adds them up
and the driver gets ``k`` rows of sums, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import discard, staged

#: Vectors of a block.
BLOCK = 4096
#: Components are clamped to this, so that a squared distance fits 64 bits.
LARGEST = 2**27
#: Up to here products of components add up exactly in double precision.
_EXACT = 2**22
#: Share by which bounds are loosened, far above rounding and far below a gap that matters.
_SLACK = 1e-9

_STATE = "ids binary, named binary, n int, kind string, vectors binary, cluster binary, keys binary, members binary, sizes binary"
_SUMS = "sums array<array<long>>, counts array<long>, inertia array<long>, popped long"


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances (int64) of the rows of ``x`` to ``centroids``."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= _EXACT // 8:
        a, b = x.astype(np.float64), centroids.astype(np.float64)
        out = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)
        return out.astype(np.int64)
    wide = x.astype(np.int64)
    return np.stack([((wide - c) ** 2).sum(axis=1) for c in centroids.astype(np.int64)], axis=1)


class Block:
    """Some vectors with their clusters and the clusters' heaps."""

    def __init__(self, vectors: np.ndarray, k: int) -> None:
        self.vectors = vectors
        self.cluster = np.zeros(len(vectors), np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]

    def rescan(self, rows: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> None:
        """Assign ``rows`` to their nearest centroids (the smaller number on a
        tie) and push their gaps."""
        if not len(rows):
            return
        d = squared_distances(self.vectors[rows], centroids)
        nearest = d.argmin(axis=1)
        own = np.sqrt(d[np.arange(len(rows)), nearest].astype(np.float64))
        d[np.arange(len(rows)), nearest] = np.iinfo(np.int64).max
        second = np.sqrt(d.min(axis=1).astype(np.float64)) if d.shape[1] > 1 else np.full(len(rows), np.inf)
        key = second - own - _SLACK * (1 + second + own) if d.shape[1] > 1 else second
        self.cluster[rows] = nearest
        for c, gap, row in zip(nearest.tolist(), (key + drift[nearest]).tolist(), rows.tolist(), strict=True):
            heapq.heappush(self.heaps[c], (gap, row))

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Pop every vector whose gap its cluster's drift has used up."""
        out = []
        for heap, reached in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] <= reached:
                out.append(heapq.heappop(heap)[1])
        return np.array(sorted(out), np.int64)

    def pack(self) -> dict:
        """Columns of the state; an array holds a heap in heap order, so it is
        a heap again when it is read."""
        flat = [entry for heap in self.heaps for entry in heap]
        return {
            "kind": self.vectors.dtype.str,
            "vectors": self.vectors.tobytes(),
            "cluster": self.cluster.tobytes(),
            "keys": np.array([key for key, _ in flat], np.float64).tobytes(),
            "members": np.array([row for _, row in flat], np.int32).tobytes(),
            "sizes": np.array([len(heap) for heap in self.heaps], np.int32).tobytes(),
        }

    @staticmethod
    def unpack(row, dim: int) -> Block:
        out = Block(np.frombuffer(row["vectors"], np.dtype(row["kind"])).reshape(-1, dim), 0)
        out.cluster = np.frombuffer(row["cluster"], np.int32).copy()
        keys, members = np.frombuffer(row["keys"], np.float64).tolist(), np.frombuffer(row["members"], np.int32).tolist()
        start = 0
        for size in np.frombuffer(row["sizes"], np.int32).tolist():
            out.heaps.append(list(zip(keys[start : start + size], members[start : start + size], strict=True)))
            start += size
        return out

    def sums(self, k: int, centroids: np.ndarray) -> tuple[list, list, list]:
        """Per cluster: componentwise sums, number of vectors, and the squared
        distances to the given centroids added up."""
        counts = np.bincount(self.cluster, minlength=k)
        total = np.zeros((k, self.vectors.shape[1]), np.int64)
        inertia = [0] * k
        for c in np.flatnonzero(counts).tolist():
            part = self.vectors[self.cluster == c]
            total[c] = part.sum(axis=0, dtype=np.int64)
            inertia[c] = sum(squared_distances(part, centroids[c : c + 1])[:, 0].tolist())
        return total.tolist(), counts.tolist(), [min(i, 2**63 - 1) for i in inertia]


def packed_vectors(df: DataFrame, id_column: str, vector_column: str, dim: int, scale: float) -> DataFrame:
    """Blocks of the vectors that count (see :func:`cluster_vectors`) in their
    integer form, in the narrowest integer type that holds them."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("ids", pa.binary()), ("named", pa.binary()), ("n", pa.int32()), ("kind", pa.string()), ("vectors", pa.binary())])
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0)
            named = np.asarray(ids.is_valid(), bool)
            ids = np.asarray(ids.fill_null(0), np.int64)
            x = np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, dim)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype(np.int64)
            for s in range(0, len(x), BLOCK):
                part = x[s : s + BLOCK]
                low, high = int(part.min()), int(part.max())
                kind = next(t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
                row = [ids[s : s + BLOCK].tobytes(), named[s : s + BLOCK].tobytes(), len(part), np.dtype(kind).str, part.astype(kind).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    rows = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    return rows.where(_whole(F.col("vector"), dim)).mapInArrow(pack, "ids binary, named binary, n int, kind string, vectors binary")


def _whole(vector: Column, dim: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == dim) & ~F.coalesce(bad, F.lit(True))


def initial_centroids(df: DataFrame, k: int, seed: int, id_column: str, vector_column: str, dim: int, scale: float) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id``, in that
    order (a top-k per task; equal ids by their components)."""
    marked = df.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    marked = marked.where(F.col("id").isNotNull() & _whole(F.col("vector"), dim))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = marked.select(mark.alias("mark"), "vector").orderBy("mark", "vector").limit(k).collect()
    x = np.array([r["vector"] for r in first], np.float64).reshape(-1, dim)
    return np.clip(np.floor(x * scale), -LARGEST, LARGEST).astype(np.int64)


def _assigned(blocks: DataFrame, dim: int, centroids: np.ndarray, drift: np.ndarray, first: bool) -> DataFrame:
    """The state after one assignment; ``blocks`` is the packed table at first
    and the state of the round before later."""
    k = len(centroids)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.to_dict("records"):
                if first:
                    block = Block(np.frombuffer(row["vectors"], np.dtype(row["kind"])).reshape(-1, dim), k)
                    moved = np.arange(row["n"])
                else:
                    block = Block.unpack(row, dim)
                    moved = block.expired(drift)
                block.rescan(moved, centroids, drift)
                sums, counts, inertia = block.sums(k, centroids)
                out = {c: row[c] for c in ("ids", "named", "n")} | block.pack()
                yield pd.DataFrame([out | {"sums": sums, "counts": counts, "inertia": inertia, "popped": len(moved)}])

    return blocks.mapInPandas(run, f"{_STATE}, {_SUMS}")


def _totals(state: DataFrame, k: int, dim: int) -> tuple[list[list[int]], list[int], list[int], int]:
    """Sums, counts and inertia per cluster over all blocks, and the number of
    vectors rescanned: ``k`` rows at the driver."""
    parts = state.select(F.posexplode(F.arrays_zip("sums", "counts", "inertia")).alias("c", "p"), F.when(F.col("c") == 0, F.col("popped")).alias("popped"))
    wide = "decimal(38,0)"
    rows = parts.groupBy("c").agg(
        F.array(*[F.sum(F.col("p.sums")[i].cast(wide)) for i in range(dim)]).alias("sums"),
        F.sum("p.counts").alias("n"), F.sum(F.col("p.inertia").cast(wide)).alias("inertia"), F.sum("popped").alias("popped")).collect()
    sums, counts, inertia, popped = [[0] * dim for _ in range(k)], [0] * k, [0] * k, 0
    for r in rows:
        sums[r["c"]], counts[r["c"]], inertia[r["c"]] = [int(s) for s in r["sums"]], r["n"], int(r["inertia"])
        popped += r["popped"] or 0
    return sums, counts, inertia, popped


def cluster_vectors(
    df: DataFrame,
    k: int = 16,
    rounds: int = 3,
    seed: int = 1,
    dim: int = 64,
    scale: float = 64.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    log: list | None = None,
) -> DataFrame:
    """Lloyd's clustering in integers: ``vec_id, cluster, distance,
    cluster_inertia, inertia, centroid_sha256``, one row per vector that counts.

    A vector counts if it has exactly ``dim`` components, none null or
    non-finite; others give no row. A component ``x`` becomes
    ``floor(scale * x)``, clamped to +-2**27 (so that distances fit 64 bits).
    The first centroids are the ``k`` vectors with the smallest SHA-256 of
    ``seed:id`` (all of them, if there are fewer). Each round assigns every
    vector to the nearest centroid, ties to the smaller number, and then moves
    each centroid that has vectors to their componentwise floored mean; an
    assignment follows the last round. Rows that share an id are clustered one
    by one; a row without id is clustered and keeps its null id, but starts no
    centroid (a table of such rows only gives no rows). Inertia beyond 64 bits
    is cut there. An empty table gives no rows; other columns are not read.

    ``log`` gets the number of vectors measured against all centroids in each
    assignment.
    """
    spark = df.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = initial_centroids(df, k, seed, id_column, vector_column, dim, scale)
    k = len(centroids)
    if not k:
        return spark.createDataFrame([], schema)
    drift = np.zeros(k)
    state = staged(_assigned(packed_vectors(df, id_column, vector_column, dim, scale), dim, centroids, drift, True), "centroid-state")
    sums, counts, inertia, popped = _totals(state, k, dim)
    if log is not None:
        log.append(popped)
    for _ in range(rounds):
        moved = centroids.copy()
        for c in range(k):
            if counts[c]:
                moved[c] = [s // counts[c] for s in sums[c]]
        step = np.sqrt(((moved - centroids).astype(np.float64) ** 2).sum(axis=1)) * (1 + _SLACK)
        others = np.array([np.delete(step, c).max(initial=0.0) for c in range(k)])
        centroids, drift = moved, drift + (step + others) * (1 + _SLACK)
        old, state = state, staged(_assigned(state, dim, centroids, drift, False), "centroid-state")
        discard(old)
        sums, counts, inertia, popped = _totals(state, k, dim)
        if log is not None:
            log.append(popped)

    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    limit = 2**63 - 1
    per_cluster = [min(i, limit) for i in inertia]
    total = min(sum(inertia), limit)

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for blocks in batches:
            for row in blocks.to_dict("records"):
                x = np.frombuffer(row["vectors"], np.dtype(row["kind"])).reshape(-1, dim)
                cluster = np.frombuffer(row["cluster"], np.int32)
                distance = np.empty(len(x), np.int64)
                for c in np.unique(cluster).tolist():
                    distance[cluster == c] = squared_distances(x[cluster == c], centroids[c : c + 1])[:, 0]
                ids = pd.array(np.frombuffer(row["ids"], np.int64), dtype="Int64")
                ids[~np.frombuffer(row["named"], bool)] = pd.NA
                yield pd.DataFrame({
                    "vec_id": ids, "cluster": cluster, "distance": distance, "cluster_inertia": [per_cluster[c] for c in cluster.tolist()],
                    "inertia": total, "centroid_sha256": [digests[c] for c in cluster.tolist()]})

    return state.select("ids", "named", "kind", "vectors", "cluster").mapInPandas(rows_of, schema)
