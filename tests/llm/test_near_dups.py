"""SimHash and embedding near-duplicates against brute force over all pairs."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rollcall.llm import components, embeddings, simhash, staging


def classes(n, linked):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocabulary = [f"Wort{i}é" for i in range(300)]
    out = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(300)]
        out.append(" ".join(base))
        for _ in range(8):
            other = list(base)
            for _ in range(rng.randint(0, 2)):
                other[rng.randrange(len(other))] = rng.choice(vocabulary)
            out.append("\t".join(other))
    return [*out, None, "", " \n", "one two", "ONE two", "a b c d", " ".join(vocabulary * 70)]


def test_simhash_matches_brute_force(spark, texts, monkeypatch):
    rows = [(100 - i if i else None, t, 7, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, fingerprint string")
    fps = [fingerprint(t) for t in texts]
    root = classes(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 4)
    least = {}
    for (ident, *_), r in zip(rows, root, strict=True):
        if ident is not None:
            least[r] = min(least.get(r, ident), ident)
    want = {(row[0], f"{fps[i]:016x}", least.get(root[i])) for i, row in enumerate(rows)}
    for dense, tile in ((64, 1024), (2, 3)):  # joins alone, then tiles
        monkeypatch.setattr(simhash, "DENSE", dense)
        monkeypatch.setattr(simhash, "TILE", tile)
        got = simhash.near_duplicate_classes(df)
        assert got.columns == ["doc_id", "text", "fp", "fingerprint", "component_id"]
        assert {(r.doc_id, r.fingerprint, r.component_id) for r in got.collect()} == want


def test_simhash_links_at_every_distance(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    marks = set(base)
    for b in base:
        for d in range(1, 8):
            x = b
            for bit in rng.sample(range(64), d):
                x ^= 1 << bit
            marks.add(x)
    marks = sorted(np.array(list(marks), np.uint64).view(np.int64).tolist())
    links = simhash.fingerprint_links(spark.createDataFrame([(m,) for m in marks], "fp long"), 4)
    got = {r.node: r.root for r in components.connected_components(links, "a", "b").collect()}
    u = np.array(marks).view(np.uint64)
    root = classes(len(u), lambda i, j: bin(int(u[i]) ^ int(u[j])).count("1") <= 4)
    assert [got.get(m, m) for m in marks] == [marks[r] for r in root]


def test_exploded_rows_are_not_broadcast(spark, monkeypatch):
    # a small table by its estimate: its cells and their variants are 3 and 64 times as many
    plans = {}

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return staging.staged(df, name)

    monkeypatch.setattr(simhash, "staged", spy)
    links = simhash.fingerprint_links(spark.range(500).select(F.xxhash64("id").alias("fp")), 4)
    plan = links._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"SortMergeJoin \[k#\d+L\], \[k#\d+L\], Inner", plan)) == 2, plan
    assert not re.search(r"Broadcast\w+Join \[k#", plan), plan
    assert "SortMergeJoin [seg#" in plans["simhash-members"] and "Broadcast" not in plans["simhash-members"], plans
    assert links.count() == 0


def test_one_of_each_class_stays(spark):
    t = " ".join(f"w{i}" for i in range(200))
    rows = [(5, t, "a"), (3, t, "b"), (3, t, "b"), (9, "other words entirely here", "c"), (None, "null id text stands alone", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = simhash.keep_one_of_each(df)
    assert out.columns == df.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, df.where("doc_id = 3 OR doc_id = 9 OR doc_id IS NULL").distinct().collect()))
    assert simhash.keep_one_of_each(df.limit(0)).count() == 0
    assert simhash.near_duplicate_classes(df.limit(0)).count() == 0


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 80)], "none": [(4, 4)],
             "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]}[shape]
    edges = edges + edges[:3]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    pairs = {(max(a, b), min(a, b)) for a, b in edges if a != b}
    root = classes(200, lambda i, j: (i, j) in pairs)
    assert got == {n: root[n] for n in {x for p in pairs for x in p}}


def vectors():
    rng = np.random.default_rng(2)
    out = []
    for label in (0, 1, None):
        for _ in range(15):
            base = rng.standard_normal(24)
            out.append((label, base))
            for _ in range(6):
                out.append((label, base + rng.standard_normal(24) * rng.choice([0.0, 0.08, 0.14, 0.2]) * 1.4))
    return out


def test_vectors_match_brute_force(spark, monkeypatch):
    rows = [(i, [float(np.float32(x)) for x in v], label, i) for i, (label, v) in enumerate(vectors())]
    n = len(rows)
    rows += [(n, None, 0, 1), (n + 1, [0.0] * 24, 0, 1), (n + 2, [float("nan")] + [1.0] * 23, 0, 1), (n + 3, [1.0, None], 0, 1),
             (n + 4, [float("inf")] * 24, 0, 1), (n + 5, [], 0, 1), (n + 6, [1.0] * 5, 0, 1), (n + 7, [2.0] * 5, 0, 1),
             (n + 8, [1.0] * 5, 0, 1), (n + 9, [1e30] * 24, 0, 1), (n + 10, [1e-30] * 24, 0, 1)]
    df = spark.createDataFrame([*rows, (None, [1.0] * 24, 0, 1)], "vec_id long, embedding array<float>, label int, key int")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v, np.float32).astype(np.float64)
        a /= np.abs(a).max()
        return a / np.linalg.norm(a)

    units = [unit(r[1]) for r in rows]

    def linked(i, j):
        a, b = units[i], units[j]
        return a is not None and b is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b >= 0.98

    root = classes(len(rows), linked)
    links = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    assert sum(links) > 100
    want = {(i, links[i], root[i], root[i] == i) for i in range(len(rows))} | {(None, 0, None, False)}
    for tile in (2048, 4):
        monkeypatch.setattr(embeddings, "TILE", tile)
        monkeypatch.setattr(embeddings, "SIZED", 1 if tile < 9 else 16)
        monkeypatch.setattr(embeddings, "UNIT", 3 if tile < 9 else 512)
        got = embeddings.near_duplicate_vectors(df).collect()
        assert len(got) == df.count() and {tuple(r) for r in got} == want
    assert embeddings.near_duplicate_vectors(df.limit(0)).count() == 0


def test_bounds_hold(spark):
    """The dropped pairs are never links, and the estimates have no bias."""
    rng = np.random.default_rng(4)
    dim, n = 64, 4000
    turn = embeddings.rotations(dim, dim, 1)
    a = rng.standard_normal((n, dim))
    b = a + rng.standard_normal((n, dim)) * 0.2
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    ra, rb = a @ turn, b @ turn
    signs = np.sign(ra) / math.sqrt(dim)
    factor = np.abs(ra).sum(axis=1) / math.sqrt(dim)
    estimate = (signs * rb).sum(axis=1) / factor
    true = (a * b).sum(axis=1)
    assert abs((estimate - true).mean()) < 0.003
    bound = np.sqrt(1 / factor**2 - 1) * np.sqrt(1 - true**2) * 6 / math.sqrt(dim - 1)
    assert (np.abs(estimate - true) <= bound + 1e-9).all()


def test_few_pairs_at_the_threshold_differ_in_more_bits():
    rng = np.random.default_rng(5)
    bits = 128
    limit = embeddings.most_differing(bits, 0.98, 1e-6)
    a = rng.standard_normal((20_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    other = rng.standard_normal((20_000, 64))
    other -= (a * other).sum(axis=1, keepdims=True) * a
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    b = 0.98 * a + math.sqrt(1 - 0.98**2) * other
    turn = embeddings.rotations(64, bits, 1)
    differing = ((a @ turn > 0) != (b @ turn > 0)).sum(axis=1)
    assert differing.max() <= limit and ((a[:-1] @ turn > 0) != (a[1:] @ turn > 0)).sum(axis=1).min() > limit


def test_label_of_any_type_and_double_precision(spark):
    near = math.cos(math.acos(0.98) + 1e-9)  # beyond single precision of the threshold
    rows = [(1, [1.0, 0.0], "a"), (2, [near, math.sqrt(1 - near**2)], "a"), (3, [1.0, 0.0], "b"), (4, [0.99, math.sqrt(1 - 0.99**2)], "b")]
    got = embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {tuple(r) for r in got} == {(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)}


def test_join_groups_keeps_large_groups_in_place(spark):
    from rollcall.llm.staging import join_groups

    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50).alias("k"), F.lit(1).alias("group_large"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = join_groups(rows, groups, ["k"], "n")
    want = rows.join(groups, "k").select("id", "k", "group_large", "n", "top")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 9000
