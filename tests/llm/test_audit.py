"""Filter audit against applying every order to every document."""

from __future__ import annotations

import math
import random
import re
from itertools import permutations

import pytest

from rollcall.llm import audit

DOCS = "doc_id long, text string, source string, mask string, n long"


def mask(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
    }


def brute(docs, labels):
    rows = [(i, t or "", s or "") for i, t, s in docs]
    fails = []
    for i, t, _ in rows:
        smaller = any(j is not None and i is not None and j < i and u == t for j, u, _ in rows)
        fails.append({f for f, x in (mask(t) | {"E": smaller}).items() if x})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = []
    for part in {p for _, _, p in rows}:
        mine = [(i, f) for (i, _, p), f in zip(rows, fails, strict=True) if p == part]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                total[f] += len(gone)
                steps.append((f, (part, "".join(order), step, len(left), len(gone), sum(f in x for _, x in mine) - len(gone),
                                  sum(x == {f} for _, x in mine), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
        out += [(*r, total[f]) for f, r in steps]
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ümlaut", "Word", "CAPS", "日本", "😀x"]
    texts = [None, "", " \t\n", "x" * 300_000, "A" * 4, "# " + " ".join(words), "a b \x1c c", " ".join(words * 400)]
    for _ in range(60):
        t = " ".join(rng.choices(words[: rng.choice([20, 400, 405])], k=rng.choice([10, 49, 50, 51, 90])))
        texts.append(rng.choice(["", "\t", "# ", "%"]) + (t.upper() if rng.random() < 0.2 else t))
    docs = [(rng.randrange(n), rng.choice(texts), rng.choice([None, "", "a", "b", "a"])) for _ in range(n)]
    docs += [(None, texts[9], "a"), (None, texts[9], None), (1, texts[9], "b")] + [(2, texts[10], "a")] * 70 + [(3 + i, texts[10], "a") for i in range(70)]
    labels = [(rng.randrange(n), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(n)] + [(None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_matches_every_order(spark, broadcast):
    docs, labels = corpus(4, 150)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = spark.createDataFrame([(i, t, s, "clash", 7) for i, t, s in docs], DOCS)
        out = audit.audit_filters(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
        got = sorted(map(tuple, out.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert got == brute(docs, labels)


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    no_labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit_filters(none, no_labels).collect() == []
    docs = [(1, "plain text", None), (2, "plain text", None)]
    out = audit.audit_filters(spark.createDataFrame([(*d, "", 0) for d in docs], DOCS), no_labels)
    assert sorted(map(tuple, out.collect())) == brute(docs, [])


def test_path_counts_are_orders():
    reaching, leaving = audit.path_counts(5)
    for state in range(32):
        assert reaching[state] == math.factorial(state.bit_count()) and leaving[state] == math.factorial(5 - state.bit_count())
    for order in range(5):  # through any level, all 120 orders pass
        level = [s for s in range(32) if s.bit_count() == order]
        assert sum(reaching[s] * leaving[s] for s in level) == 120
