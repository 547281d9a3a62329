"""Scoring texts with a deleted-interpolation bigram model.

The probability of a token mixes three estimates: of the bigram and of the
word by maximum likelihood, and the uniform one. The weights depend on how
often the context was seen (by powers of two) and come from
expectation-maximisation on held-out counts: each training token is scored by
the counts without itself.

Documents are packed into blocks of about a million tokens. A block asks once for
the corpus counts of its distinct words and bigrams: the requests (sorted
64-bit hashes with the block's own training counts) are shuffled by hash
range, added up there, and the totals go back to the blocks. So a frequent
word costs one entry per block, and no task holds more than a block or a hash
range. Two n-grams with equal 64-bit hashes would share a count.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged

BLOCK_TOKENS = 1_000_000
BLOCK_DOCS = 8_000
#: Requested n-grams of a hash range, on average (at most twice as many).
RANGE_KEYS = 400_000
BUCKETS = 40  # context-frequency buckets: 0, 1, 2-3, 4-7, ...
STEPS_PER_OCTAVE = 4  # of the probabilities in the held-out table
EMPTY_CELL = 255
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# not words, since words hold no white space
END, START = b"\nend", b"\nstart"


def _pack(a: np.ndarray) -> bytes:
    """An integer array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(raw: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def _unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack(raw, np.uint64), dtype=np.uint64)


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_fold(ident, fold: int, folds: int) -> bool:
    return zlib.crc32(b"" if ident is None or pd.isna(ident) else str(int(ident)).encode()) % folds == fold


def pack_blocks(df: DataFrame, fold: int, folds: int) -> DataFrame:
    """Blocks of documents: ids, held-out flags, lengths, word hashes (the end
    is word 0, the start word 1) and tokens as numbers of those words."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made = TaskContext.get(), 0
        part = task.partitionId() if task else 0
        words: dict[bytes, int] = {}
        ids: list = []
        tokens: list[np.ndarray] = []
        total = 0

        def block() -> pd.DataFrame:
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
            return pd.DataFrame({
                "block": [part * (1 << 31) + made], "ids": [ids], "held": [[in_fold(i, fold, folds) for i in ids]],
                "lengths": [[len(t) for t in tokens]], "words": [hashes.tobytes()],
                "tokens": [_pack(np.concatenate(tokens).astype(np.uint32))],
                "n_train": [sum(len(t) for t, i in zip(tokens, ids, strict=True) if not in_fold(i, fold, folds))],
                "n_keys": [len(words) + total],
            })

        words |= {END: 0, START: 1}
        for rows in batches:
            for ident, text in zip(rows["doc_id"], rows["text"], strict=True):
                found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
                own = np.empty(len(found) + 1, np.uint32)
                own[:-1] = [words.setdefault(w, len(words)) for w in found]
                own[-1] = 0
                ids.append(None if pd.isna(ident) else int(ident))
                tokens.append(own)
                total += len(own)
                if total >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield block()
                    made, total, words, ids, tokens = made + 1, 0, {END: 0, START: 1}, [], []
        if ids:
            yield block()

    schema = ("block long, ids array<long>, held array<boolean>, lengths array<int>, words binary, tokens binary, "
              "n_train long, n_keys long")
    return df.select("doc_id", "text").mapInPandas(pack, schema)


class Block:
    """The arrays of one block, with its distinct n-grams in hash order."""

    def __init__(self, row) -> None:
        self.ids = row.ids
        self.lengths = np.asarray(row.lengths, np.int64)
        self.held = np.repeat(np.asarray(row.held, bool), self.lengths)
        hashes = np.frombuffer(row.words, np.uint64)
        self.tokens = _unpack(row.tokens, np.uint32).astype(np.int64)
        self.context = np.empty_like(self.tokens)
        self.context[1:] = self.tokens[:-1]
        self.context[np.cumsum(self.lengths) - self.lengths] = 1
        pairs, self.pair = np.unique(self.context * len(hashes) + self.tokens, return_inverse=True)
        pair_keys = _pair_hash(hashes[pairs // len(hashes)], hashes[pairs % len(hashes)])
        self.order = (np.argsort(hashes, kind="stable"), np.argsort(pair_keys, kind="stable"))
        self.keys = (hashes[self.order[0]], pair_keys[self.order[1]])
        self.sizes = (len(hashes), len(pairs))

    def training_counts(self, kind: int) -> np.ndarray:
        """Of the distinct n-grams, in hash order. (The start is no token; its
        count is that of the training documents.)"""
        train = ~self.held
        if kind:
            return np.bincount(self.pair[train], minlength=self.sizes[1])[self.order[1]]
        counts = np.bincount(self.tokens[train], minlength=self.sizes[0])
        counts[1] = counts[0]
        return counts[self.order[0]]

    def set_totals(self, parts) -> None:
        """Corpus counts per token: of the word, its context and the bigram."""
        totals = []
        for kind in (0, 1):
            own = sorted((p["range"], p["totals"]) for p in parts if p["kind"] == kind)
            got = np.concatenate([_unpack(raw, np.uint64) for _, raw in own]).astype(np.float64)
            back = np.empty(self.sizes[kind])
            back[self.order[kind]] = got
            totals.append(back)
        self.word_count = totals[0][self.tokens]
        self.context_count = totals[0][self.context]
        self.pair_count = totals[1][self.pair]


def corpus_counts(blocks: DataFrame, bits: int) -> DataFrame:
    """``block, kind, range, totals, n_types``: per block and hash range, the
    training counts over all blocks of its n-grams, in hash order."""

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples(index=False):
                block = Block(row)
                for kind in (0, 1):
                    keys, counts = block.keys[kind], block.training_counts(kind).astype(np.uint32)
                    numbers = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    starts = np.flatnonzero(np.diff(numbers, prepend=-1))
                    ends = [*starts[1:].tolist(), len(keys)]
                    yield pd.DataFrame({
                        "kind": kind, "range": numbers[starts], "block": row.block,
                        "keys": [_pack_sorted(keys[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)],
                        "counts": [_pack(counts[a:b]) for a, b in zip(starts.tolist(), ends, strict=True)],
                    })

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack_sorted(raw) for raw in rows["keys"]]
        counts = np.concatenate([_unpack(raw, np.uint32) for raw in rows["counts"]])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(which, counts, minlength=len(distinct))
        start_key = np.uint64(xxhash.xxh64_intdigest(START))
        types = int((totals[distinct != start_key] > 0).sum()) if rows["kind"].iat[0] == 0 else int((totals > 0).sum())
        mine = totals[which].astype(np.uint64)
        ends = np.cumsum([len(k) for k in keys])
        return pd.DataFrame({
            "block": rows["block"], "kind": rows["kind"], "range": rows["range"],
            "totals": [_pack(mine[e - len(k) : e]) for e, k in zip(ends.tolist(), keys, strict=True)],
            "n_types": types,
        })

    asked = blocks.select("block", "ids", "held", "lengths", "words", "tokens").mapInPandas(
        ask, "kind int, range long, block long, keys binary, counts binary")
    schema = "block long, kind int, range long, totals binary, n_types long"
    return asked.groupBy("kind", "range").applyInPandas(add_up, schema)


@dataclass
class MixtureWeights:
    """Weights of (bigram, word, uniform) by context-frequency bucket."""

    tokens: int
    types: int
    weights: list[list[float]] = field(default_factory=list)


def bucket_of(count: np.ndarray) -> np.ndarray:
    return np.where(count >= 1, np.minimum(np.floor(np.log2(np.maximum(count, 1))) + 1, BUCKETS - 1), 0).astype(np.int64)


def held_out_cells(blocks: DataFrame, tokens: int) -> DataFrame:
    """``bucket, q2, q1, n``: how many training tokens have, by the counts
    without themselves, such a context bucket and such bigram and word
    probabilities (in steps of a quarter octave; 255: zero)."""

    def step(p: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            q = np.floor(-np.log2(p) * STEPS_PER_OCTAVE)
        return np.where(p > 0, np.minimum(np.nan_to_num(q, posinf=EMPTY_CELL), EMPTY_CELL - 1), EMPTY_CELL).astype(np.int64)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples(index=False):
                b = Block(row)
                b.set_totals(row.parts)
                t = ~b.held
                rest = b.context_count[t] - 1
                p2 = np.where(rest > 0, (b.pair_count[t] - 1) / np.maximum(rest, 1), 0.0)
                p1 = (b.word_count[t] - 1) / max(tokens - 1, 1)
                cell = (bucket_of(rest) * 256 + step(p2)) * 256 + step(p1)
                distinct, n = np.unique(cell, return_counts=True)
                yield pd.DataFrame({"bucket": distinct >> 16, "q2": distinct >> 8 & 255, "q1": distinct & 255, "n": n})

    cells = blocks.mapInPandas(count, "bucket int, q2 int, q1 int, n long")
    return cells.groupBy("bucket", "q2", "q1").agg(F.sum("n").alias("n"))


def learn_weights(cells: pd.DataFrame, tokens: int, types: int, rounds: int = 60) -> MixtureWeights:
    """Expectation-maximisation per bucket over the held-out table (at most
    BUCKETS * 256 * 256 cells, whatever the corpus)."""

    def probability(q: pd.Series) -> np.ndarray:
        return np.where(q == EMPTY_CELL, 0.0, np.exp2(-(q.to_numpy(float) + 0.5) / STEPS_PER_OCTAVE))

    out = []
    for bucket in range(BUCKETS):
        own = cells[cells["bucket"] == bucket]
        lam = np.array([0.0 if bucket == 0 else 0.4, 0.4, 0.2])
        lam /= lam.sum()
        p = np.stack([probability(own["q2"]), probability(own["q1"]), np.full(len(own), 1 / (types + 1))], axis=1)
        n = own["n"].to_numpy(float)
        if len(own):
            for _ in range(rounds):
                share = p * lam
                share /= share.sum(axis=1, keepdims=True)
                lam = n @ share
                lam = lam / lam.sum()
            # keep every estimate possible, so that no text gets probability zero
            lam = lam * (1 - 1e-6) + 1e-6 * np.array([0.0 if bucket == 0 else 1.0, 1.0, 1.0]) / (2 if bucket == 0 else 3)
        elif out:
            lam = np.array(out[-1]) if bucket > 1 else lam
        out.append(lam.tolist())
    return MixtureWeights(tokens, types, out)


def score_blocks(blocks: DataFrame, model: MixtureWeights) -> DataFrame:
    table, tokens, types = np.array(model.weights), model.tokens, model.types

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples(index=False):
                b = Block(row)
                b.set_totals(row.parts)
                lam = table[bucket_of(b.context_count)]
                p = lam[:, 0] * b.pair_count / np.maximum(b.context_count, 1)
                p += lam[:, 1] * b.word_count / max(tokens, 1) + lam[:, 2] / (types + 1)
                base = np.log10((b.word_count + 1) / (tokens + types + 1))
                doc = np.repeat(np.arange(len(b.lengths)), b.lengths)
                yield pd.DataFrame({
                    "doc_id": pd.array([None if i is None or pd.isna(i) else int(i) for i in b.ids], "Int64"),
                    "held_out": np.asarray(row.held, bool),
                    "n_tokens": b.lengths,
                    "n_known": np.bincount(doc, b.word_count > 0, minlength=len(b.lengths)).astype(np.int64),
                    "train_tokens": tokens,
                    "base_score": np.bincount(doc, base, minlength=len(b.lengths)),
                    "score": np.bincount(doc, np.log10(p), minlength=len(b.lengths)),
                })

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.mapInPandas(score, schema)


def train_and_score(df: DataFrame, fold: int = 2, folds: int = 7) -> tuple[DataFrame, MixtureWeights]:
    """Scores of all documents, and the mixture weights behind them."""
    # one block in memory at a time
    blocks = staged(pack_blocks(df, fold, folds), "lm-blocks")
    sums = blocks.agg(F.sum("n_train"), F.sum("n_keys")).first()
    tokens, keys = int(sums[0] or 0), int(sums[1] or 0)
    bits = max(0, math.ceil(math.log2(max(1, keys / RANGE_KEYS))))
    totals = staged(corpus_counts(blocks, bits), "lm-counts")
    per_range = totals.where("kind = 0").groupBy("range").agg(F.max("n_types").alias("n"))
    types = int(per_range.agg(F.sum("n")).first()[0] or 0)
    answers = totals.groupBy("block").agg(F.collect_list(F.struct("kind", "range", "totals")).alias("parts"))
    full = blocks.select("block", "ids", "held", "lengths", "words", "tokens").join(answers, "block")
    cells = held_out_cells(full, tokens).toPandas()
    model = learn_weights(cells, tokens, types)
    return score_blocks(full, model), model


def score_documents(df: DataFrame, fold: int = 2, folds: int = 7) -> DataFrame:
    """Language-model scores of every text: ``doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score``.

    A-Z is lower-cased; tokens are runs without ASCII white space and one end
    per text. The model learns from the documents whose crc32 of the id as
    text, modulo ``folds``, is not ``fold`` (a null id: of the empty text).
    ``base_score`` is the add-one unigram score and ``score`` the model's
    log10 probability. A null text counts as empty: only its end is scored.
    Repeated rows are scored each. Without training documents only the
    uniform estimate is left; an empty table gives no rows.
    """
    return train_and_score(df, fold, folds)[0]
