"""Embedding near-duplicates by randomised-rotation binary codes.

Every unit vector is rotated at random and only the signs are kept, with the
correction factor ``f`` = inner product of the vector and its code. For a code
``c`` of a vector ``o`` and any other rotated vector ``q``, ``<c, q> / f``
estimates ``<o, q>`` without bias, and its error is at most
``sqrt(1 / f**2 - 1) * sqrt(1 - <o, q>**2) * epsilon / sqrt(D - 1)`` up to a
chance that falls with ``exp(-epsilon**2 / 2)``. A pair whose bound stays
below the threshold is dropped; only the others are computed exactly.

Which pairs are looked at: the sign bits of several rotations are cut into
bands, and vectors of one label meet where a band agrees. Bits differ with
chance angle / pi, so the number of bands follows from the chance that a pair
at the threshold may be missed. A pair is counted in the first band on which it
agrees. Only ids and bits travel to their bands, packed; there the share of
differing bits, which estimates the angle, and its Chernoff bound tell which
vectors may have a partner. Their vectors alone are fetched, for the estimate
above and the exact product. Buckets too large for a task are cut into tiles. A
bucket returns link counts and a spanning star per local class, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .staging import discard, join_groups, staged, worker_state

#: Vectors on each side of a tile, about.
TILE = 4096
#: Expected vectors of one label and bucket if codes were spread evenly.
PER_BUCKET = 256
#: Buckets that one cell holds: 2 ** SHARED_BITS.
SHARED_BITS = 4
#: Vectors of a cell that travel as one row.
UNIT = 512
#: One node in so many counts towards the size of its cells, which only says
#: into how many tiles a cell is cut.
SIZED = 16
#: Rows of a block of the pair matrices.
BLOCK = 1024
CELL = ["label", "dim", "band", "prefix"]


def rotations(dim: int, bits: int, seed: int) -> np.ndarray:
    """``dim`` x (a multiple of ``dim``, at least ``bits``): random orthogonal
    matrices side by side."""
    rng = np.random.default_rng([seed, dim])
    count = max(1, -(-bits // dim))
    parts = []
    for _ in range(count):
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        parts.append(q * np.sign(np.diag(r)))
    return np.concatenate(parts, axis=1)


def band_plan(largest: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits of a band, number of bands) for ``largest`` vectors of a label."""
    width = min(24, max(6, math.ceil(math.log2(max(1, largest / PER_BUCKET)))))
    agree = (1 - math.acos(min(1.0, threshold)) / math.pi) ** width
    return width, max(1, math.ceil(math.log(miss) / math.log(1 - agree))) if agree < 1 else 1


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    norm = F.aggregate(vector, F.lit(0.0), lambda a, x: a + F.abs(x.cast("double")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.coalesce(norm, F.lit(0.0)) > 0)


def _rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """:func:`rotations`, made once a worker process."""
    known = worker_state()
    name = ("rotation", dim, bits, seed)
    if name not in known:
        known[name] = rotations(dim, bits, seed)
    return known[name]


def most_differing(bits: int, threshold: float, miss: float) -> int:
    """The number of differing bits that a pair at the threshold exceeds with a
    chance of at most ``miss`` (Chernoff)."""
    p = max(math.acos(min(1.0, threshold)) / math.pi, 1e-9)
    for h in range(math.ceil(bits * p), bits):
        q = max(h / bits, 1e-12)
        apart = q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0)
        if q > p and math.exp(-bits * apart) <= miss:
            return h
    return bits


def _unit(vectors) -> np.ndarray:
    x = np.stack(vectors).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _codes(nodes: DataFrame, width: int, bands: int, seed: int) -> DataFrame:
    """``nodes`` plus ``dim``, ``bits`` (of all bands), ``code`` and ``factor``."""

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            dims = rows["vector"].map(len)
            for dim, part in rows.groupby(dims, sort=False):
                turned = _unit(part["vector"].to_numpy()) @ _rotation(dim, width * bands, seed)
                first = turned[:, :dim]
                yield part.assign(
                    dim=dim,
                    bits=[b.tobytes() for b in np.packbits(turned[:, : width * bands] > 0, axis=1)],
                    code=[b.tobytes() for b in np.packbits(first > 0, axis=1)],
                    factor=np.abs(first).sum(axis=1) / math.sqrt(dim),
                )

    schema = "node long, label string, copies long, vector array<double>, dim int, bits binary, code binary, factor double"
    return nodes.select("node", "label", "copies", "vector").mapInPandas(code, schema)


def _band_keys(bits: list[bytes] | np.ndarray, width: int, bands: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1)
    return np.unpackbits(raw, axis=1, count=width * bands).reshape(len(raw), bands, width) @ (1 << np.arange(width, dtype=np.int32))


def _packed(width: int, bands: int) -> np.dtype:
    return np.dtype([("node", "<i8"), ("key", "<i4"), ("bits", f"V{-(-width * bands // 8)}")])


def _units(coded: DataFrame, width: int, bands: int) -> DataFrame:
    """Per band the ids and bits of the vectors of a cell, some rows a cell."""
    kind = _packed(width, bands)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if not len(rows):
                continue
            keys = _band_keys(list(rows["bits"]), width, bands)
            (label, names), dim = pd.factorize(rows["label"]), rows["dim"].to_numpy()
            one = np.empty(len(rows), kind)
            one["node"], one["bits"] = rows["node"].to_numpy(), np.frombuffer(b"".join(rows["bits"]), kind["bits"])
            for band in range(bands):
                one["key"], prefix = keys[:, band], keys[:, band] >> SHARED_BITS
                order = np.lexsort((prefix, dim, label))
                cell = np.stack([label[order], dim[order], prefix[order]])
                new = np.flatnonzero(np.r_[True, (cell[:, 1:] != cell[:, :-1]).any(axis=0)])
                edges = [x for s, e in zip(new.tolist(), [*new[1:].tolist(), len(order)], strict=True) for x in range(s, e, UNIT)]
                raw, ends = one[order].tobytes(), [*edges[1:], len(order)]
                yield pd.DataFrame({
                    "label": np.asarray(names, object)[cell[0, edges]], "dim": cell[1, edges], "band": band, "prefix": cell[2, edges],
                    "n": np.subtract(ends, edges), "unit": [raw[s * kind.itemsize : e * kind.itemsize] for s, e in zip(edges, ends, strict=True)]})

    return coded.select("node", "label", "dim", "bits").mapInPandas(pack, "label string, dim int, band int, prefix int, n long, unit binary")


def _promising(coded: DataFrame, width: int, bands: int, threshold: float, miss: float) -> DataFrame:
    """Vectors whose bits leave room for a partner in a tile of a cell: ``CELL,
    i, j, chunk, node``."""
    kind, total = _packed(width, bands), width * bands
    limit = most_differing(total, threshold, miss)
    some = coded.where(F.pmod(F.xxhash64("node"), F.lit(SIZED)) == 0)
    sizes = _units(some, width, bands).groupBy(*CELL).agg((F.sum("n") * SIZED).alias("size")).where(F.col("size") > 2 * TILE)
    large = staged(sizes.select(*CELL, F.ceil(F.col("size") / TILE).cast("int").alias("chunks")), "vector-large")
    units = _units(coded, width, bands).join(large, CELL, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    units = units.withColumn("chunk", F.pmod(F.xxhash64("unit"), F.col("chunks")).cast("int"))
    units = units.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    units = units.select(*CELL, "chunk", "unit", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"))

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        band, i, j = int(rows["band"].iat[0]), rows["i"].iat[0], rows["j"].iat[0]
        own = np.concatenate([np.frombuffer(u, kind) for u in rows["unit"]])
        chunk = np.repeat(rows["chunk"].to_numpy(), [len(u) // kind.itemsize for u in rows["unit"]])
        order = np.argsort(own["key"], kind="stable")
        own, chunk = own[order], chunk[order]
        starts = np.flatnonzero(np.r_[True, np.diff(own["key"]) != 0])
        found = []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(own)], strict=True):
            if e - s < 2:
                continue
            here = own[s:e]
            raw = np.frombuffer(here["bits"].tobytes(), np.uint8).reshape(len(here), -1)
            signs = 2 * np.unpackbits(raw, axis=1, count=total).astype(np.float32) - 1
            keys = _band_keys([b.tobytes() for b in here["bits"]], width, bands)
            left = np.flatnonzero(chunk[s:e] == i)
            right = left if i == j else np.flatnonzero(chunk[s:e] == j)
            may = np.zeros(e - s, bool)
            for at in range(0, len(left), BLOCK):
                a = left[at : at + BLOCK]
                near = signs[a] @ signs[right].T >= total - 2 * limit
                if i == j:
                    near &= right[None, :] > a[:, None]
                p, q = np.nonzero(near)
                p, q = a[p], right[q]
                first = np.ones(len(p), bool)
                for b in range(band):  # pairs that agree on an earlier band are counted there
                    first &= keys[p, b] != keys[q, b]
                may[p[first]] = may[q[first]] = True
            found += [(n, c) for n, c in zip(here["node"][may].tolist(), chunk[s:e][may].tolist(), strict=True)]
        out = pd.DataFrame(found, columns=["node", "chunk"]).astype({"node": "int64", "chunk": "int32"})
        return out.assign(**{c: rows[c].iat[0] for c in (*CELL, "i", "j")})

    return units.groupBy(*CELL, "i", "j").applyInPandas(look, "node long, chunk int, label string, dim int, band int, prefix int, i int, j int")


def _links_in(a: dict, b: dict, same: bool, band: int, turn: np.ndarray, threshold: float, epsilon: float):
    """Index pairs (into a, into b) that link and first agree on ``band``."""
    keep = [np.empty((2, 0), np.int64)]
    for start in range(0, len(a["node"]), BLOCK):
        part = {k: v[start : start + BLOCK] for k, v in a.items()}
        keep.append(_links_of(part, b, start if same else None, band, turn, threshold, epsilon) + [[start], [0]])
    return np.concatenate(keep, axis=1)


def _links_of(a: dict, b: dict, start: int | None, band: int, turn: np.ndarray, threshold: float, epsilon: float):
    """As :func:`_links_in` for a block of rows (``start``: where it begins
    in ``b``, if both are the same vectors)."""
    dim = turn.shape[0]
    spread = math.sqrt(1 - threshold**2) * min(1.0, epsilon / math.sqrt(max(1, dim - 1)))
    maybe = None
    for one, other, flip in ((a, b, False), (b, a, True)):
        estimate = (one["signs"] @ other["turned"].T) / one["factor"][:, None]
        floor = threshold - np.sqrt(np.maximum(1 / one["factor"] ** 2 - 1, 0))[:, None] * spread - 1e-5
        near = estimate >= floor
        near = near.T if flip else near
        maybe = near if maybe is None else maybe & near
    if start is not None:
        maybe &= np.arange(len(b["node"]))[None, :] > (start + np.arange(len(a["node"])))[:, None]
    i, j = np.nonzero(maybe)
    keep = [np.empty((2, 0), np.int64)]
    for s in range(0, len(i), 100_000):
        p, q = i[s : s + 100_000], j[s : s + 100_000]
        exact = np.einsum("ij,ij->i", a["unit"][p], b["unit"][q])
        p, q = p[exact >= threshold], q[exact >= threshold]
        earlier = (a["keys"][p, :band] == b["keys"][q, :band]).any(axis=1)
        keep.append(np.stack([p[~earlier], q[~earlier]]))
    return np.concatenate(keep, axis=1)


def _stars(nodes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest node of each one's local class."""
    label = nodes.copy()
    while True:
        old = label.copy()
        np.minimum.at(label, left, old[right])
        np.minimum.at(label, right, old[left])
        # step on through the labels of labels
        label = np.minimum(label, label[np.searchsorted(nodes, label)])
        if np.array_equal(label, old):
            return label


def vector_links(nodes: DataFrame, threshold: float = 0.98, epsilon: float = 6.0, miss: float = 1e-8, seed: int = 1) -> DataFrame:
    """``node, links, root``, some rows per node: parts of its number of links
    (copies of a vector each count) and an edge to a node of its class.
    ``nodes``: ``node`` (long), ``label``, ``copies``, ``vector``; vectors of
    one label are distinct and usable."""
    largest = nodes.groupBy("label", F.size("vector").alias("d")).count().agg(F.max("count")).first()[0] or 0
    width, bands = band_plan(largest, threshold, miss)
    coded = staged(_codes(nodes, width, bands, seed), "vector-codes")
    wanted = staged(_promising(coded, width, bands, threshold, miss / 100), "vector-wanted")
    rows = wanted.join(coded.select("label", "dim", "node", "copies", "vector", "bits", "code", "factor"), ["label", "dim", "node"])

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        band, dim = int(rows["band"].iat[0]), int(rows["dim"].iat[0])
        i, j = rows["i"].iat[0], rows["j"].iat[0]
        keys = _band_keys(list(rows["bits"]), width, bands)
        # (of vectors that share an id, those of this cell)
        order = np.lexsort((rows["node"].to_numpy(), keys[:, band]))
        order = order[keys[order, band] >> SHARED_BITS == rows["prefix"].iat[0]]
        rows, keys = rows.iloc[order], keys[order]
        turn = _rotation(dim, dim, seed)
        unit = _unit(rows["vector"].to_numpy())
        codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
        signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32)
        data = {
            "unit": unit,
            "turned": (unit @ turn).astype(np.float32),
            "signs": (2 * signs - 1) / np.float32(math.sqrt(dim)),
            "factor": rows["factor"].to_numpy(),
            "keys": keys,
            "node": rows["node"].to_numpy(),
            "copies": rows["copies"].to_numpy(),
            "chunk": rows["chunk"].to_numpy(),
        }
        key = keys[:, band]
        starts = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
        out = []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(key)], strict=True):
            if e - s < 2:
                continue
            own = {k: v[s:e] for k, v in data.items()}
            a = {k: v[own["chunk"] == i] for k, v in own.items()}
            b = a if i == j else {k: v[own["chunk"] == j] for k, v in own.items()}
            p, q = _links_in(a, b, i == j, band, turn, threshold, epsilon)
            if not len(p):
                continue
            left, right = a["node"][p], b["node"][q]
            both = np.unique(np.concatenate([left, right]))
            li, ri = np.searchsorted(both, left), np.searchsorted(both, right)
            links = np.bincount(li, b["copies"][q], len(both)) + np.bincount(ri, a["copies"][p], len(both))
            out.append(pd.DataFrame({"node": both, "links": links.astype(np.int64), "root": _stars(both, li, ri)}))
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")

    return rows.groupBy(*CELL, "i", "j").applyInPandas(compare, "node long, links long, root long")


def near_duplicate_vectors(
    df: DataFrame,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    **params,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors of one (not null) label and length link where their cosine is at
    least ``threshold``. A vector that is null, empty, zero or has null or
    non-finite components, or has no label, links with nothing: it is a class
    of its own. Copies of a vector count one link each. Rows that share an id
    are one vertex; a row without id is returned with 0 links, a null class
    and kept = false, and counts for nobody. An empty table gives no rows.
    """
    rows = df.select(
        F.col(f"`{id_column}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
        F.col(f"`{label_column}`").cast("string").alias("label"),  # whatever its type
    )
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("vector"))
    grouped = rows.where(able).groupBy("label", "vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    # a vector by two hashes: rows find their group without moving it
    marks = [F.xxhash64(F.lit(i), "vector").alias(f"h{i}") for i in (1, 2)]
    nodes = staged(grouped.select("*", *marks), "vectors")
    found = staged(vector_links(nodes, threshold, **params), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "node", "root").withColumnRenamed("root", "class")
    ranked = (
        nodes.select("label", "h1", "h2", "node", "copies").join(links, "node", "left").join(roots, "node", "left")
        .select("label", "h1", "h2", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("class", "node").alias("component_id"))
    )
    ranked = staged(ranked, "vector-classes")
    discard(nodes)
    discard(found)
    same = ["label", "h1", "h2"]
    linked = join_groups(rows.where(able).select("vec_id", "label", *marks), ranked, same, "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where(~able).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionAll(alone).withColumn("kept", kept)
