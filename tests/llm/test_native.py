"""Sharding, mixing and chat formatting against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.llm import chat, mixing, sharding

DOCS = "doc_id long, text string, source string, lang string, size string, shard string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "en", "x", "y") for i, t, s in rows], DOCS)


def sizes(text):
    return len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w])


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, " ".join(["w"] * (1 + (i * 7919) % 40 + (300 if i % 97 == 0 else 0))), f"s{i % 3 if i % 4 else 0}") for i in range(600)]
    rows += [(900, None, "s1"), (901, "", None), (902, "a b", None), (None, "n n n", "s2"), (903, "é ü", "Ü")]
    rows += [(904, "same text", "s1")] * 3  # repeated rows
    return docs(spark, rows)


def test_shard_slots_are_gapless_and_growth_moves_only_into_the_new_shard(spark, corpus):
    got = sharding.shard_documents(corpus, 16).collect()
    assert len(got) == corpus.count()
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    for slots in per.values():
        assert sorted(slots) == list(range(len(slots)))
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in corpus.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    again = sharding.shard_documents(corpus.repartition(7), 16).collect()
    assert Counter(got) == Counter(again)


def test_shard_shares_follow_weights(spark):
    df = spark.range(20_000).select(sharding.rendezvous(F.col("id"), [1.0, 3.0]).alias("s"))
    share = df.where("s = 1").count() / 20_000
    assert abs(share - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), [1.0, 0.0])


def test_slots_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_RANGE", 10)
    monkeypatch.setattr(sharding, "COPIES_PER_PIECE", 4)
    df = spark.range(500).select((F.col("id") % 100).alias("v"), F.lit("k").alias("shard"))
    got = sharding.number_rows(df, "shard").collect()
    assert sorted(r.slot for r in got) == list(range(500))


def test_empty_tables(spark, corpus):
    none = corpus.limit(0)
    assert sharding.shard_documents(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert mixing.repeat_rows(none, mixing.mix_sources(none)).count() == 0
    assert chat.conversation_digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def targets(per, weights=(5.0, 2.0, 1.0), most=3.0):
    """Water filling, one excess at a time."""
    names = sorted(per, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), float(sum(per.values()))
    while open_:
        rate = left / sum(w[s] for s in open_)
        over = {s for s in open_ if rate * w[s] >= most * per[s]}
        if not over:
            out |= {s: rate * w[s] for s in open_}
            break
        for s in over:
            out[s] = most * per[s]
            left -= out[s]
        open_ -= over
    return out


def test_mix_reaches_targets(spark, corpus):
    got = mixing.mix_sources(corpus).cache()
    rows = corpus.collect()
    per = Counter()
    for r in rows:
        per[r.source] += sizes(r.text)
    want = targets(per)
    taken = Counter()
    for r in got.collect():
        assert r.source_size == per[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(60, 0.02 * t), (s, taken[s], t)
    assert Counter((r.doc_id, r["size"]) for r in got.collect()) == Counter((r.doc_id, sizes(r.text)) for r in rows)
    assert Counter(mixing.mix_sources(corpus.repartition(5)).collect()) == Counter(got.collect())
    repeated = mixing.repeat_rows(corpus, got)
    assert repeated.columns == corpus.columns
    assert repeated.count() == got.agg(F.sum("copies")).first()[0]


def test_pivotal_rounding_keeps_expectations(spark):
    p = 0.3
    ups = 0
    for seed in range(8):
        rows = spark.range(400).select(
            F.lit("s").alias("stratum"), F.lit(400).cast("bigint").alias("n_rows"), F.struct("id").alias("id"),
            F.xxhash64("id", F.lit(seed)).alias("rank"), F.lit(1.0).alias("size"), F.lit(p).alias("p"))
        out = mixing.pivotal_rounding(rows, seed).collect()
        assert len(out) == 400 and abs(sum(r.up for r in out) - 400 * p) <= 1
        ups += sum(r.up for r in out if r.id.id < 100)
    assert abs(ups / 800 - p) < 0.08


def test_one_source_and_no_words(spark):
    df = docs(spark, [(1, None, "a"), (2, "", "a")])
    assert [(r.source_size, r.target, r.taken) for r in mixing.mix_sources(df).collect()] == [(0, 0.0, 0)] * 2


def test_conversations_read_back(spark):
    rows = [
        (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
        (1, 2, "assistant", "b"), (1, 1, "user", "a&amp;<+>"), (1, 3, "assistant", None), (1, 4, "assistant", "é😀<s:user>"),
        (2, None, None, None), (2, 0, "a>b&gt;</s>", "x"), (2, 0, "a>b&gt;</s>", "x"), (None, 1, "assistant", "lone"),
        (3, 0, "assistant", "z" * 100_000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.conversation_digest(df.withColumn("formatted", F.lit(1))).collect()}
    groups = defaultdict(list)
    for c, t, role, text in rows:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(groups)
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, _, role, x in turns if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{role}\n{x}\n" for _, _, role, x in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))
    out = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    assert out[1].formatted.count("<s:assistant>") == 1  # neighbours are merged
    for r in out.values():
        assert got[r.conv_id].formatted_chars == len(r.formatted)
        for span in r.loss_spans:
            assert "<" not in r.formatted[span.start : span.end]


def test_a_row_that_fills_a_third_of_the_table_is_repeated(spark):
    rows = [(i, f"some words {i}", "a", 1) for i in range(800)] + [(5000, "the very same words", "a", 2)] * 400 + [(5001, "another pair", "b", i) for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, row_place int").repartition(5)
    from rollcall.llm.staging import staged

    df = staged(df, "test-third")
    mixed = staged(mixing.mix_sources(df), "test-mixed")
    out = mixing.repeat_rows(df, mixed)
    assert out.columns == df.columns
    want = {r[0]: r[1] for r in mixed.groupBy("doc_id").sum("copies").collect()}
    got = {r[0]: r[1] for r in out.groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}
    kinds = [r[0] for r in out.where("doc_id = 5001").groupBy("row_place").count().select("count").collect()]
    assert not kinds or max(kinds) - (min(kinds) if len(kinds) == 3 else 0) <= 1  # shared as evenly as can be


def test_long_conversations_cost_in_proportion(spark):
    import time

    def seconds(n):
        df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                                   F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("words <&> "), 12).alias("text"))
        start = time.time()
        row = chat.conversation_digest(df).collect()[0]
        assert row.n_turns == n and row.loss_chars == n // 2 * 120
        return time.time() - start

    seconds(2000)
    small, large = min(seconds(4000) for _ in range(2)), seconds(32_000)
    assert large < 30 * small + 5  # eight times the turns; far from 64 times
