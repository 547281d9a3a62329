"""Toxicity: a counterfactually regularised linear classifier.

A text is a set of features: its words, the beginnings of its words (4, 5
and 6 letters, which catch inflected forms) and, in scripts without spaces
between words, all runs of two and three characters. Spark counts in how many
labelled texts of either class each feature occurs, over all training rows, and
keeps the features that mark toxic texts more clearly than chance would. (Clean
texts are counted second, and only for the features that can still pass.) A logistic model over
them is fitted on a bounded sample of training rows with a ridge penalty, plus,
for each sentence of them that names a group, the squared change of its logit
when the identity term is swapped for another one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import staged

# Identity terms that may be swapped for one another, by kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "trans", "nonbinary"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("gay", "lesbian", "bisexual", "straight", "queer"),
    ("immigrants", "refugees", "natives", "foreigners", "citizens"),
    ("deaf", "blind", "disabled", "autistic"),
    ("old", "young", "elderly"),
)
WORDS = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"[.!?\n]+")
STEMS = (4, 5, 6)
#: Thai, Lao, Tibetan, Myanmar, Khmer, Kana and Han.
UNSPACED = re.compile(r"[\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]{2,}")
GRAMS = (2, 3)
#: The name of a longer word's feature ends in a hash.
LONG_WORD = 40
#: Bits of the hash by which clean texts' features are sifted.
SIEVE_BITS = 24
#: Words remembered per scoring task before the memo starts again.
MEMO = 500_000


def word_features(word: str) -> list[str]:
    """The features one word gives: itself, its beginnings, and the short runs
    of its characters where the script has no spaces between words."""
    whole = word if len(word) <= LONG_WORD else f"{word[:8]}#{xxhash.xxh64_hexdigest(word.encode('utf-8', 'surrogatepass'))}"
    grams = {f"~{run[i : i + n]}" for run in UNSPACED.findall(word) for n in GRAMS for i in range(len(run) - n + 1)}
    return [whole, *[f"{word[:n]}~" for n in STEMS if len(word) >= n], *grams]


def features(text: str | None) -> set[str]:
    return {f for w in set(WORDS.findall((text or "").lower())) for f in word_features(w)}


def swapped(text: str, terms: dict[str, tuple[str, ...]]) -> list[tuple[set[str], set[str]]]:
    """(features, features after the swap) of each sentence with an identity
    term; every such term moves on to the next of its kind."""
    out = []
    for sentence in SENTENCE_END.split(text.lower()):
        words = WORDS.findall(sentence)
        if any(w in terms for w in words):
            other = [(g := terms[w])[(g.index(w) + 1) % len(g)] if w in terms else w for w in words]
            out.append(({f for w in words for f in word_features(w)}, {f for w in other for f in word_features(w)}))
    return out


@dataclass
class ToxicityModel:
    """Weights by feature, and a bias. ``score`` is the logistic of their sum."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0

    def scorer(self) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
        weights, bias = self.weights, self.bias

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            memo: dict[str, tuple[str, ...]] = {}
            for texts in batches:
                out = np.empty(len(texts))
                for i, text in enumerate(texts):
                    found: set[str] = set()
                    for w in set(WORDS.findall((text or "").lower())):
                        known = memo.get(w)
                        if known is None:
                            if len(memo) >= MEMO:
                                memo.clear()
                            known = memo[w] = tuple(f for f in word_features(w) if f in weights)
                        if known:
                            found.update(known)
                    out[i] = bias + sum(weights[f] for f in sorted(found))
                yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(out, -500, 500))))

        return score

    def score(self, text: Column) -> Column:
        """Toxicity between 0 and 1 of a text column (a null or empty text
        scores as the bias alone)."""
        return F.pandas_udf(self.scorer(), "double")(text)


def _design(rows: list[set[str]], index: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, feature numbers) of the ones of a sparse 0/1 matrix."""
    at, cols = [], []
    for i, found in enumerate(rows):
        hit = sorted(index[f] for f in found if f in index)
        at.append(np.full(len(hit), i, np.int64))
        cols.append(np.array(hit, np.int64))
    return (np.concatenate(at), np.concatenate(cols)) if rows else (np.empty(0, np.int64), np.empty(0, np.int64))


def fit_logistic(
    rows: list[set[str]],
    labels: np.ndarray,
    offsets: np.ndarray,
    pairs: list[tuple[set[str], set[str]]],
    vocabulary: Sequence[str],
    evidence: np.ndarray,
    l2: float,
    counterfactual: float,
    steps: int,
    n0: int,
    n1: int,
) -> ToxicityModel:
    """Accelerated gradient descent on: mean log loss + ``counterfactual`` *
    mean squared logit change of the pairs + half ``l2`` * sum of squared
    distances of the weights from ``evidence`` (each feature's own log ratio,
    so that a word counts even where others always stood beside it).
    Classes weigh alike; ``n0`` and ``n1`` count the training rows of either
    label, of which ``rows`` may be a sample, and give the bias its prior.
    ``offsets`` is what features outside ``vocabulary`` add to each row."""
    if not len(rows) or len(set(labels.tolist())) < 2:
        return ToxicityModel({}, float(np.log((n1 + 0.5) / (n0 + 0.5))) if n0 + n1 else -3.0)
    index = {f: i for i, f in enumerate(vocabulary)}
    r, c = _design(rows, index)
    pr, pc = _design([a for a, _ in pairs], index)
    qr, qc = _design([b for _, b in pairs], index)
    n, m, k = len(rows), len(vocabulary), len(pairs)
    weight = np.where(labels == 1, n / (2 * labels.sum()), n / (2 * (n - labels.sum()))) / n

    def gradient(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = np.bincount(r, w[c], minlength=n) + b + offsets
        e = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - labels)
        g = np.bincount(c, e[r], minlength=m)
        if k:
            d = np.bincount(pr, w[pc], minlength=k) - np.bincount(qr, w[qc], minlength=k)
            d *= 2 * counterfactual / k
            g += np.bincount(pc, d[pr], minlength=m) - np.bincount(qc, d[qr], minlength=m)
        return g + l2 * (w - evidence), float(e.sum())

    # Steps in units of each feature's own curvature, and of the largest eigenvalue of what is left.
    scale = np.sqrt(0.25 * np.bincount(c, weight[r], minlength=m) + l2 + 1e-12)
    if k:
        both = np.bincount(pc, minlength=m) + np.bincount(qc, minlength=m)
        scale = np.sqrt(scale**2 + 2 * counterfactual / k * both)
    x, xb, top = np.ones(m), 1.0, 1.0
    for _ in range(30):
        z = 0.25 * weight * (np.bincount(r, (x / scale)[c], minlength=n) + xb / 0.5)
        y, yb = np.bincount(c, z[r], minlength=m) / scale, float(z.sum()) / 0.5
        if k:
            d = np.bincount(pr, (x / scale)[pc], minlength=k) - np.bincount(qr, (x / scale)[qc], minlength=k)
            d *= 2 * counterfactual / k
            y += (np.bincount(pc, d[pr], minlength=m) - np.bincount(qc, d[qr], minlength=m)) / scale
        y += l2 * x / scale**2
        top = float(np.sqrt((y**2).sum() + yb**2))
        x, xb = y / max(top, 1e-12), yb / max(top, 1e-12)
    rate, rate_b = 1 / (1.1 * top * scale**2), 1 / (1.1 * top * 0.25)
    w, b, v, vb, t = evidence.copy(), 0.0, evidence.copy(), 0.0, 1.0
    for _ in range(steps):
        g, gb = gradient(v, vb)
        new = v - rate * g
        new_b = vb - rate_b * gb
        if ((v - new) / rate) @ (new - w) + (vb - new_b) / rate_b * (new_b - b) > 0:
            t = 1.0  # the momentum points uphill: start it again
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = new + (t - 1) / t_next * (new - w), new_b + (t - 1) / t_next * (new_b - b)
        w, b, t = new, new_b, t_next
    # the classes weighed alike; three quarters of the way back to their shares of all training rows
    prior = float(np.log(n1 / n0))
    return ToxicityModel({vocabulary[i]: float(w[i]) for i in np.flatnonzero(w)}, b + 0.75 * prior)


def sieve(counted: DataFrame) -> bytes:
    """A bit for each hash of ``SIEVE_BITS``: whether a feature of ``counted``
    has it."""
    h = F.xxhash64("feature").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    parts = counted.groupBy(F.shiftright(h, 15).alias("at")).agg(F.bitmap_construct_agg(h.bitwiseAND(F.lit(32767))).alias("bits"))
    out = bytearray(1 << SIEVE_BITS - 3)
    for r in parts.collect():
        out[r["at"] * 4096 : (r["at"] + 1) * 4096] = r["bits"]
    return bytes(out)


def feature_counts(labelled: DataFrame, sifted: bytes | None = None) -> DataFrame:
    """``feature, n0, n1``: in how many texts of each label it occurs. Counts
    combine within a task before the shuffle. With ``sifted``, features whose
    bit is not set there are left out (some others stay)."""
    shared = None if sifted is None else labelled.sparkSession.sparkContext.broadcast(sifted)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, list[int]] = {}
        memo: dict[str, tuple[str, ...]] = {}
        bits = b"" if shared is None else shared.value

        def out() -> pd.DataFrame:
            table = pd.DataFrame.from_dict(seen, orient="index", columns=["n0", "n1"])
            return table.rename_axis("feature").reset_index().astype({"feature": str})

        def passes(feature: str) -> bool:
            h = xxhash.xxh64_intdigest(feature.encode("utf-8", "surrogatepass"), 42) & (1 << SIEVE_BITS) - 1
            return bool(bits[h >> 3] >> (h & 7) & 1)

        def wanted(text: str | None) -> set[str]:
            found: set[str] = set()
            for w in set(WORDS.findall((text or "").lower())):
                known = memo.get(w)
                if known is None:
                    known = tuple(f for f in word_features(w) if passes(f))
                    if len(w) <= LONG_WORD:
                        if len(memo) >= MEMO:
                            memo.clear()
                        memo[w] = known
                if known:
                    found.update(known)
            return found

        find = wanted if bits else features
        for rows in batches:
            for text, label in zip(rows["text"], rows["label"], strict=True):
                for f in find(text):
                    if (pair := seen.get(f)) is None:
                        pair = seen[f] = [0, 0]
                    pair[int(label)] += 1
                if len(seen) >= MEMO:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    parts = labelled.select("text", "label").mapInPandas(count, "feature string, n0 long, n1 long")
    return parts.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def train(
    labelled: DataFrame,
    max_rows_per_label: int = 6_000,
    max_features: int = 4_000,
    least_rows: int = 3,
    least_ratio: float = 3.0,
    l2: float = 3e-3,
    counterfactual: float = 1.0,
    identity_terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    steps: int = 1500,
    seed: int = 4,
) -> ToxicityModel:
    """Fit on ``labelled`` (``text`` string, ``label`` 0 or 1; other labels and
    nulls are left out).

    Feature counts cover every row. The fit itself uses at most
    ``max_rows_per_label`` rows of each label, chosen by a hash of the text
    (equal texts count once there), and changes the weights of the best
    ``max_features`` features: both are bounds of the driver's memory. The other
    features that mark toxic texts weigh by their log ratios. Without rows of both labels the model is
    a constant.
    """
    rows = labelled.select("text", F.col("label").cast("int").alias("label")).where("label in (0, 1)")
    order = F.xxhash64("text", F.lit(seed))
    rows = staged(rows.withColumn("o", order), "toxicity-rows")
    toxic = staged(feature_counts(rows.where("label = 1")).where(F.col("n1") >= least_rows), "toxicity-features")
    totals = rows.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in totals}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    p0, p1 = (F.col("n0") + 0.5) / (n0 + 1), (F.col("n1") + 0.5) / (n1 + 1)
    # log-likelihood gain of a rate of its own per class; ln(features) is what the best of as many
    # chance features reaches, so a feature of one class needs clearly more than that
    pool = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    gain = F.col("n1") * F.ln(p1 / pool) + F.col("n0") * F.ln(p0 / pool)
    chance = float(np.log(100 * max(toxic.count(), 1)))
    # the gain is largest for a feature of no clean text; a feature that fails even so needs no counts there
    able = toxic.where(F.col("n1") * F.ln(p1 / ((F.col("n1") + 1) / (n0 + n1 + 2))) > chance)
    both = able.unionAll(feature_counts(rows.where("label = 0"), sieve(able)))
    counted = both.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).where("n1 > 0")
    marked = counted.where(p1 > least_ratio * p0).where(gain > chance)
    # shared out over the features that a word gives
    own = F.ln(p1 / p0) / (1 + len(STEMS))
    ranked = sorted(marked.select("feature", own.alias("own"), gain.alias("gain")).collect(), key=lambda r: (-r["gain"], r["feature"]))
    ratio = {r["feature"]: r["own"] for r in ranked}
    wanted = set(ratio) | {t for kind in identity_terms for t in kind}
    terms = {t: tuple(kind) for kind in identity_terms for t in kind}
    refitted = {r["feature"] for r in ranked[:max_features]}
    vocabulary = sorted(refitted | {f for t in terms for f in word_features(t) if f in wanted})
    evidence = np.array([ratio.get(f, 0.0) for f in vocabulary])
    rest = {f: ratio[f] for f in set(ratio).difference(vocabulary)}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = set(vocabulary)
        for part in batches:
            every = [features(t) for t in part["text"]]
            found = [sorted(x & known) for x in every]
            others = [sum(rest[f] for f in sorted(x & rest.keys())) for x in every]
            both = [[[sorted(a & known), sorted(b & known)] for a, b in swapped(t or "", terms)] for t in part["text"]]
            yield pd.DataFrame({"label": part["label"], "found": found, "others": np.array(others, float), "swaps": both})

    sample = None
    for label in (0, 1):
        own = rows.where(F.col("label") == label)
        # the last hash of the first distinct ones: only texts up to it are shuffled, copies once a task
        first = own.select("o").distinct().orderBy("o").limit(max_rows_per_label)
        last = first.agg(F.max("o")).first()[0]
        own = own.where(F.col("o") <= F.lit(last).cast("long")).select("label", "text", "o").dropDuplicates(["o"])
        sample = own if sample is None else sample.unionAll(own)
    got = sample.select("text", "label").mapInPandas(
        encode, "label int, found array<string>, others double, swaps array<array<array<string>>>").collect()
    got.sort(key=lambda r: (r["label"], r["found"], r["others"]))
    model = fit_logistic(
        [set(r["found"]) for r in got], np.array([r["label"] for r in got], float), np.array([r["others"] for r in got], float),
        [(set(a), set(b)) for r in got for a, b in r["swaps"]], vocabulary, evidence, l2, counterfactual, steps, n0, n1)
    return ToxicityModel(rest | model.weights, model.bias)


def labelled_texts(documents: DataFrame, labels: DataFrame, fold: int = 2, folds: int = 4) -> DataFrame:
    """``text, label`` of the documents outside fold ``fold`` (crc32 of the id
    as text, modulo ``folds``) that ``labels`` marks toxic or not. A document
    with labels of both kinds is toxic; null labels are skipped."""
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    # both sides lose the held-out fold before the shuffle; a merge join at every size, since labels grow with documents
    training = fold_of(F.col("doc_id"), folds) != fold
    texts = documents.select("doc_id", "text").where(training)
    return texts.join(marks.where(training).hint("merge"), "doc_id").select("text", "label")


def fold_of(ident: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % folds


def score_documents(documents: DataFrame, labels: DataFrame, threshold: float = 0.3, **params) -> DataFrame:
    """All rows and columns of ``documents`` plus ``held_out``, ``score`` and
    ``predicted`` (1 where the score is at least ``threshold``). Columns of
    those names are replaced. Only the text goes into a score. Null and empty
    texts score as the bias. Without labels the score is a small constant."""
    model = train(labelled_texts(documents, labels), **params)
    return (
        documents.withColumn("held_out", fold_of(F.col("doc_id"), 4) == 2)
        .withColumn("score", model.score(F.col("text")))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )
