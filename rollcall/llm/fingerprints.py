"""Document fingerprints by I-Match over randomised lexicons.

Terms whose document frequency lies in a band form the lexicon. Each of the
randomised lexicons is a fixed pseudo-random subset of it; a text's
fingerprint is, per subset, a hash of its sorted distinct terms' hashes in it.
Two texts that differ in few terms agree on the subsets that hold none of
those terms. Every term of the band is in some subset, so texts agree on all of
them only if they have the same terms of the band.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import shuffle_partitions

TERM = re.compile(r"[^\W_]+")
SUBSETS = 96
#: The first subsets come in pairs: a random half of the band and the other
#: half. So every term of the band is in half of them.
DENSE = 16
#: Chance that a term is in a given subset of the others: one in so many, by
#: turns. Thin subsets tell long texts apart, denser ones short texts.
THIN = (128, 512, 2048)
#: For a text with fewer terms of the band, or with a smaller share of its
#: distinct terms in the band, the subsets are drawn from all terms, and all of
#: them are halves: thin ones would hold a single term of a short text.
FEW, LEAST_SHARE = 8, 0.5
#: Document shares of the band: idf between ln(1/HIGH) and ln(1/LOW).
LOW, HIGH = 1e-3, 0.5
NONE = "-" * 8
MEMO = 500_000


def terms(text: str | None) -> set[str]:
    return set(TERM.findall((text or "").lower()))


def term_frequencies(df: DataFrame) -> DataFrame:
    """``term, df``: the number of texts with the term (equal texts each
    count). A task adds up its own rows before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for rows in batches:
            for text in rows["text"]:
                for t in terms(text):
                    seen[t] = seen.get(t, 0) + 1
            if len(seen) >= MEMO:
                yield pd.DataFrame({"term": list(seen), "df": list(seen.values())})
                seen.clear()
        if seen:
            yield pd.DataFrame({"term": list(seen), "df": list(seen.values())})

    return df.select("text").mapInPandas(count, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Lexicon:
    """The band's terms in code-point order with their subsets.

    At most (mean distinct terms of a text) / ``LOW`` terms can reach the
    band, whatever the number of texts: that bounds what is broadcast.
    """

    def __init__(self, band: list[str], seed: int = 8, draw: np.ndarray | None = None) -> None:
        self.terms = sorted(band)
        self.index = {t: i for i, t in enumerate(self.terms)}
        self.hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.terms), np.uint64, len(self.terms))
        self.seed = seed
        self.outside: dict[str, np.ndarray] = {}
        if draw is not None:
            self.draw = draw
            return
        self.draw = np.array([self.rule(t)[0] for t in self.terms], bool).reshape(-1, SUBSETS)

    def rule(self, term: str) -> tuple[np.ndarray, np.ndarray]:
        """The subsets that ``term`` is in, and those if all were halves: rules
        on the term itself, which depend on no other term nor on the lexicon."""
        found = self.outside.get(term)
        if found is None:
            raw = b"".join(hashlib.blake2b(term.encode(), digest_size=64, salt=bytes([self.seed, k])).digest() for k in range(SUBSETS // 32))
            u = np.frombuffer(raw, ">u2")
            halves = (u & 1).astype(bool)
            halves[1::2] = ~halves[::2]
            found = np.where(np.arange(SUBSETS) < DENSE, halves, u % np.resize(THIN, SUBSETS) == 0), halves
            if len(self.outside) >= MEMO // 10:
                self.outside.clear()
            self.outside[term] = found
        return found

    def fingerprint(self, text: str | None) -> list[str]:
        found = terms(text)
        index = self.index
        hit = np.array(sorted([index[t] for t in found if t in index]), np.int64)
        if len(hit) >= max(FEW, LEAST_SHARE * len(found)):
            hashes, draw = self.hashes[hit], self.draw[hit]
        else:
            # too few terms of the lexicon: halves of all terms
            names = sorted(found)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
            draw = np.array([self.rule(t)[1] for t in names], bool).reshape(-1, SUBSETS)
        out = [NONE] * SUBSETS
        chosen = np.ascontiguousarray(draw.T)
        # the terms of a subset by their hashes, in order of the terms
        raw, start = hashes[np.nonzero(chosen)[1]].tobytes(), 0
        for k, n in enumerate(chosen.sum(axis=1).tolist()):
            if n:
                out[k] = xxhash.xxh32_hexdigest(raw[start : start + 8 * n], k)
            start += 8 * n
        return out


def likeness(a: list[str], b: list[str]) -> float:
    """Share of the subsets with a term of either text on which both agree."""
    used = [(x, y) for x, y in zip(a, b, strict=True) if x != NONE or y != NONE]
    return sum(x == y for x, y in used) / len(used) if used else 1.0


def build_lexicon(df: DataFrame, low: float = LOW, high: float = HIGH) -> Lexicon:
    """The lexicon of the texts of ``df`` (column ``text``): terms in more
    than one text whose document share lies in [``low``, ``high``]."""
    n = df.count()
    band = term_frequencies(df).where((F.col("df") > 1) & (F.col("df") >= low * n) & (F.col("df") <= high * n))
    return Lexicon([r[0] for r in band.select("term").collect()])


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as
    many code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _in_id_ranges(df: DataFrame, parts: int) -> DataFrame:
    """Rows (``range_no, doc_id, tie, text, real``) in ranges of ascending id,
    each followed by the first row of the next range (the last one by the
    first of all) as a row that is not ``real``."""
    rows = df.select("doc_id", F.xxhash64("text").alias("tie"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = df.select(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    cuts = sorted(set(cuts or []))

    @F.pandas_udf("int")
    def range_no(ids: pd.Series) -> pd.Series:
        return pd.Series([0 if pd.isna(i) else bisect_left(cuts, i) for i in ids], dtype="int32")

    rows = rows.withColumn("range_no", range_no("doc_id"))
    # the first row of each range, by id (null first) and content
    order = F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", "tie")
    heads = rows.groupBy("range_no").agg(F.min_by(F.struct("doc_id", "tie", "text"), order).alias("head"))
    heads = heads.select("range_no", "head.*")
    spans = heads.select("range_no").collect()
    numbers = sorted(r[0] for r in spans)
    if not numbers:
        return rows.withColumn("real", F.lit(True))
    before = F.create_map(*[F.lit(x) for pair in zip(numbers, [numbers[-1], *numbers[:-1]], strict=True) for x in pair])
    guests = heads.select("doc_id", "tie", "text", before[F.col("range_no")].alias("range_no"), F.lit(False).alias("real"))
    both = rows.withColumn("real", F.lit(True)).unionByName(guests)
    last = F.struct((~F.col("real")).alias("x"), F.col("doc_id").isNotNull().alias("a"), "doc_id", "tie")
    # a range is a task: their numbers are the partitions'
    return both.repartitionById(parts, F.col("range_no")).sortWithinPartitions("range_no", last)


def fingerprint_documents(df: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text: ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one with the next id; equal ids are ordered by
    text hash, null ids come first, and the last one's next is the first. A
    null text counts as empty. A fingerprint is 96 parts of 8 hex digits
    (``--------``: no term of that subset). For a text with fewer than ``FEW``
    terms of the lexicon, or with less than ``LEAST_SHARE`` of its terms there,
    the subsets are random halves of all its terms. Each text is shuffled once,
    to ranges of ids. An empty table gives no rows.
    """
    spark = df.sparkSession
    lexicon = lexicon or build_lexicon(df)
    shared: Broadcast = spark.sparkContext.broadcast((lexicon.terms, lexicon.draw))

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        band, draw = shared.value
        lex, held = Lexicon(band, draw=draw), None
        for rows in batches:
            out = []
            for ident, text, real, number in zip(rows["doc_id"], rows["text"], rows["real"], rows["range_no"], strict=True):
                marks = lex.fingerprint(text)
                if held is not None and held[3] == number:
                    other = edited(held[1], text)
                    changed = lex.fingerprint(other)
                    out.append((None if pd.isna(held[0]) else int(held[0]), len(held[1]), sha(other), "".join(held[2]),
                                "".join(changed), likeness(held[2], changed), likeness(held[2], marks)))
                held = (ident, text, marks, number) if real else None
            if out:
                names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
                yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ranged = _in_id_ranges(df.select("doc_id", "text"), shuffle_partitions(spark))
    return ranged.select("doc_id", "text", "real", "range_no").mapInPandas(run, schema)
