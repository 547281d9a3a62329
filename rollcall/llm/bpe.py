"""BPE encoding with reuse of content-defined chunks.

A text is cut where a rolling hash of its last bytes hits a pattern, so equal
passages are cut alike wherever they stand. Cuts move on to the next ASCII
white space if one is near; those joins are exact for a tokenizer that drops
white space between pre-tokens. Any other join is repaired: a window around it
is encoded again, and widened, until what both chunks hold beyond it agrees.
(A tokenizer without that property encodes each text whole.)

Documents are brought together by the chunk with the smallest hash (ranges of another
hash of it and id, so that a large group of copies is split), and each worker process
keeps the tokens of the chunks that it has met. New chunks of many texts are encoded
together, through the tokens of their words (letters, and the marks behind them),
which are kept as well; both stores are bounded.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .letters import LetterWords, letters_stay, of_letters, stems_and_marks, strings
from .staging import free_name, give_back, shuffle_partitions, worker_state

WINDOW = 24  # bytes under the rolling hash
MEAN_CHUNK = 512  # one cut per so many bytes, about
NEAR = 64  # a cut moves at most so many bytes to white space
BLOCK = 1 << 16  # bytes hashed at a time
CHUNKS_KEPT = 20_000
WORDS_KEPT = 150_000
#: Characters of text that are encoded together.
BATCH_CHARS = 1 << 20
_SPACE = re.compile(r"[ \t-\r]+")
_SPACES = b" \t\n\x0b\x0c\r"  # iterates as byte values
_GAP = re.compile(rb"[ \t-\r]")
_P = 0x9E3779B1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**32: prefix sums
    then give the hash of every window."""
    n = BLOCK + WINDOW
    powers, inverse = np.full(n, _P, np.uint32), np.full(n, pow(_P, -1, 1 << 32), np.uint32)
    powers[0] = inverse[0] = 1
    return np.cumprod(powers, dtype=np.uint32), np.cumprod(inverse, dtype=np.uint32)


class Chunker:
    def __init__(self, mean: int = MEAN_CHUNK, near: int = NEAR) -> None:
        self.near = near
        self.powers, self.inverse = _tables()
        self.below = np.uint32(1 << (32 - max(1, int(mean).bit_length() - 1)))

    def _marks(self, data: np.ndarray) -> np.ndarray:
        out = []
        for start in range(0, len(data), BLOCK):
            lo = max(0, start - WINDOW)
            part = data[lo : start + BLOCK].astype(np.uint32)
            first, n = max(WINDOW, start - lo + 1), len(part)
            if first > n:
                continue
            part *= self.powers[:n]
            sums = np.zeros(n + 1, np.uint32)
            np.cumsum(part, dtype=np.uint32, out=sums[1:])
            windows = slice(first - WINDOW, n + 1 - WINDOW)
            hashed = (sums[first:] - sums[windows]) * self.inverse[windows]
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x85EBCA6B)
            out.append(np.flatnonzero(hashed < self.below) + (first + lo))
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def cuts(self, raw: bytes) -> list[int]:
        """End offsets of the chunks of ``raw`` (UTF-8), never inside a
        character. A chunk has white space in it, unless it is the last."""
        out, last = [], 0
        for mark in self._marks(np.frombuffer(raw, np.uint8)).tolist():
            if mark <= last or mark >= len(raw):
                continue
            near = _GAP.search(raw, mark, mark + self.near)
            cut = near.start() if near else mark
            while cut < len(raw) and raw[cut] & 0xC0 == 0x80:
                cut += 1
            if last < cut < len(raw) and _GAP.search(raw, last + 1, cut):
                out.append(cut)
                last = cut
        return [*out, len(raw)] if raw else []

    def key(self, text: str | None) -> int:
        """A hash of the chunk whose other hash is smallest. (The smallest hash
        itself would bring long texts, which have many chunks, together.)"""
        raw, last, best = (text or "").encode("utf-8", "replace"), 0, b"\xff" * 16
        for cut in self.cuts(raw):
            best = min(best, hashlib.blake2b(raw[last:cut].strip(_SPACES), digest_size=16).digest())
            last = cut
        return int.from_bytes(best[8:], "big") >> 1


class ChunkEncoder:
    """Encodes texts exactly as ``tokenizers`` does for the whole text."""

    def __init__(self, tokenizer_json: str, mean: int = MEAN_CHUNK, near: int = NEAR) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        spec["truncation"] = spec["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.chunker = Chunker(mean, near)
        self.chunks: dict[bytes, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.encoded_chunks = 0
        self.repairs = 0
        self.by_word = _splits_at_space(spec)
        plain = spec.get("decoder") is None
        names = _token_strings(self.tokenizer)
        self.names = names if plain and self.by_word else None
        # every id's text with a space behind it, for :meth:`joined`
        self.numbers = pa.array([f"{i} " for i in range(len(names))], pa.large_string())
        self.spaced = pa.array([n + " " for n in names], pa.large_string())
        end = (spec.get("model") or {}).get("end_of_word_suffix")
        self.letters = None
        if self.by_word and end and _letters_alone(spec) and letters_stay(spec):
            self.letters = LetterWords(self.tokenizer, "", np.array([n.endswith(end) for n in names]), np.int32)

    def plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _of_chunks(self, keys: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each chunk, as packed 32-bit numbers."""
        found = dict(zip(keys, map(self.chunks.get, keys), strict=True))
        new = [k for k, ids in found.items() if ids is None]
        if new:
            self.encoded_chunks += len(new)
            made = dict(zip(new, self._by_words(new), strict=True))
            found |= made
            if len(self.chunks) + len(made) > CHUNKS_KEPT:
                self.chunks.clear()
            self.chunks |= islice(made.items(), CHUNKS_KEPT)
        return found

    def _by_words(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, from those of its words, as Arrow arrays; the
        pieces of words that are not in the store are learned together."""
        words = pa.compute.ascii_split_whitespace(pa.array(texts, pa.string()))
        coded = words.values.dictionary_encode()
        stems, marks = stems_and_marks(coded.dictionary, True) if self.letters else (coded.dictionary, pa.array([""] * len(coded.dictionary), pa.string()))
        stems, marks = stems.dictionary_encode(), marks.dictionary_encode()
        pieces = strings(stems.dictionary) + strings(marks.dictionary)
        found = list(map(self._learn(pieces).__getitem__, pieces))
        ends = np.cumsum([0, *map(len, found)]) // 4
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(found), np.int32)))
        # every word is two lists of ids: its letters', and its marks'
        place = np.stack([stems.indices.to_numpy(), marks.indices.to_numpy() + len(stems.dictionary)], axis=1)
        taken = lists.take(pa.array(place[coded.indices.to_numpy()].ravel()))
        at = 4 * taken.offsets.to_numpy()[2 * words.offsets.to_numpy().astype(np.int64)]
        raw = taken.values.to_numpy().tobytes()
        return [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of ``pieces``, which go into the store. When it is full, it
        becomes the old one, from which pieces in use are taken over."""
        found = dict(zip(pieces, map(self.words.get, pieces), strict=True))
        new = [x for x, ids in found.items() if ids is None]
        if not new:
            return found
        if len(self.words) + len(new) > WORDS_KEPT:
            self.old, self.words = self.words, {}
        made = {x: ids for x, ids in zip(new, map(self.old.get, new), strict=True) if ids is not None}
        new = [x for x in new if x not in made]
        if self.letters:
            made |= self.letters.ids([x for x in new if of_letters(x) and x == x.lower()])
            new = [x for x in new if x not in made]
        for x, e in zip(new, self.tokenizer.encode_batch(new, add_special_tokens=False), strict=True):
            made[x] = np.array(e.ids, np.int32).tobytes()
        self.words |= made
        return found | made

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def encode_batch(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (and the
        last one's end)."""
        if self.by_word:
            raws = [(t or "").encode("utf-8", "replace") for t in texts]
            cuts = list(map(self.chunker.cuts, raws))
            chunks = [[raw[a:b].strip(_SPACES) for a, b in zip([0, *ends], ends)] for raw, ends in zip(raws, cuts, strict=True)]
            found = self._of_chunks([c for many in chunks for c in many])
            made = [self._together(raw, ends, [found[c] for c in many]) for raw, ends, many in zip(raws, cuts, chunks, strict=True)]
        else:  # no places known where parts are independent
            made = [np.array(self.plain(t or ""), np.int32).tobytes() for t in texts]
        return np.frombuffer(b"".join(made), np.int32), np.cumsum([0, *map(len, made)]) // 4

    def _together(self, raw: bytes, cuts: list[int], ids: list[bytes]) -> bytes:
        """The ids of a text from those of its chunks."""
        joins = [k for k, cut in enumerate(cuts[:-1]) if raw[cut] not in _SPACES and raw[cut - 1] not in _SPACES]
        if not joins:
            return b"".join(ids)
        out, last = bytearray(), 0
        for k in joins:  # the chunk behind each of these parts a word with the one before
            if k >= last:
                out += b"".join(ids[last : k + 1])
            out = self._repaired(raw, cuts[k - 1] if k else 0, cuts[k], cuts[k + 1], out, ids[k + 1])
            last = k + 2
        return bytes(out + b"".join(ids[last:]))

    def _repaired(self, raw: bytes, start: int, cut: int, end: int, left: bytearray, right: bytes) -> bytearray:
        """Tokens across the join at ``cut``, which parts a word: encode a
        window from white space before it to white space after it, and widen
        it until the rest of both sides agrees with what they hold."""
        self.repairs += 1
        a, b = cut, cut
        while True:
            a = max(start, max(raw.rfind(s, start, a) for s in _SPACES))
            b = min([p for p in (raw.find(s, b + 1, end) for s in _SPACES) if p >= 0], default=end)
            drop, skip = self._by_words([raw[a:cut], raw[cut:b]])
            kept = len(left) - len(drop)
            if (left[kept:] == drop and right[: len(skip)] == skip) or (a == start and b == end):
                middle = np.array(self.plain(raw[a:b].decode("utf-8")), np.int32).tobytes()
                return left[:kept] + middle + right[len(skip) :]

    def decode(self, ids: list[int]) -> str:
        if self.names is not None:
            return " ".join([self.names[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False)

    def joined(self, of: pa.Array, ids: np.ndarray, edges: np.ndarray) -> list[memoryview]:
        """For each text the UTF-8 of what ``of`` (``numbers`` or ``spaced``)
        has for its ids, joined by one space."""
        if not len(ids):
            return [memoryview(b"")] * (len(edges) - 1)
        taken = of.take(pa.array(ids))
        at = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][edges].tolist()
        raw = memoryview(taken.buffers()[2])
        return [raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:], strict=True)]


def _token_strings(tokenizer) -> list[str]:
    names = tokenizer.get_vocab(with_added_tokens=True)
    out = [""] * (max(names.values()) + 1)
    for name, i in names.items():
        out[i] = name
    return out


def _splits_at_space(spec: dict) -> bool:
    """True where the tokenizer drops white space between pre-tokens, so that
    the parts around ASCII white space are independent. Known for a Split that
    removes all but the matches of a pattern which matches no white space (after
lower-casing, which :func:`_parts` relies on)."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    pattern = (first.get("pattern") or {}).get("Regex", "")
    plain = pattern.replace(r"[^\s\p{L}\p{N}]+", "")
    added_alone = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not _SPACE.search(t["content"])
                      for t in spec.get("added_tokens", []))
    lower = "Lowercase" in json.dumps(spec.get("normalizer") or {})
    return (lower and first.get("type") == "Split" and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and r"\s" not in plain and r"\S" not in plain and "." not in plain and " " not in plain and added_alone)


def _letters_alone(spec: dict) -> bool:
    """True where a word of lower-case letters is one pre-token as it is: of
    byte-level BPE behind a Split in which only contractions come before
    letters (see :func:`_splits_at_space`), with normal forms that keep it."""
    first, *more = (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])
    kinds = first["pattern"]["Regex"].split("|")
    letters = r"[\p{L}]+"
    normal = spec.get("normalizer") or {}
    spaces_only = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ")
                      for n in normal.get("normalizers", [normal]))
    bytes_only = len(more) == 1 and more[0]["type"] == "ByteLevel" and not more[0].get("add_prefix_space") and not more[0].get("use_regex", True)
    return spaces_only and bytes_only and letters in kinds and all(k.startswith("'") for k in kinds[: kinds.index(letters)])


def near_by_content(df: DataFrame, text_column: str, id_column: str) -> DataFrame:
    """``df`` in ranges of (:meth:`Chunker.key`, id, text hash): texts that
    share chunks meet in a task, and large groups are split."""
    key = free_name(df, "content_key")

    @F.pandas_udf("long")
    def smallest(texts: pd.Series) -> pd.Series:
        chunker = Chunker()
        return pd.Series([chunker.key(t) for t in texts], dtype="int64")

    text = F.col(f"`{text_column}`")
    keyed = df.withColumn(key, smallest(text))
    order = [F.col(key), F.col(f"`{id_column}`"), F.xxhash64(text)]
    return keyed.repartitionByRange(shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order).drop(key)


def _over_texts(tokenizer_json: str, make: Callable[[ChunkEncoder, list[str | None]], pd.DataFrame], text: Column, schema: str) -> Column:
    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # one encoder a worker process: later tasks go on with the chunks that it knows
        name = hashlib.sha256(tokenizer_json.encode()).hexdigest()
        encoder = worker_state().setdefault(name, None) or ChunkEncoder(tokenizer_json)
        worker_state()[name] = encoder
        for texts in batches:
            made = []
            for some in _groups(texts.tolist()):
                made.append(make(encoder, some))
                give_back()
            yield pd.concat(made, ignore_index=True)

    return run(text)


def _groups(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in groups of about ``BATCH_CHARS`` (one group at least)."""
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= BATCH_CHARS:
            yield texts[begin : i + 1]
            begin, size = i + 1, 0
    if begin < len(texts) or not texts:
        yield texts[begin:]


def encode_documents(df: DataFrame, tokenizer_path: str, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """All rows and columns of ``df`` plus ``ids`` (array of int) and
    ``decoded`` (the text that those ids decode to, special tokens kept).

    Equal to ``tokenizers`` on each whole text with add_special_tokens=False
    and no truncation or padding. A null or empty text has no ids and decodes
    to the empty text. Columns of those names are replaced; row order is not
    kept. The tokenizer file is read by the driver.
    """

    def make(encoder: ChunkEncoder, texts: list[str | None]) -> pd.DataFrame:
        found, edges = encoder.encode_batch(texts)
        ids = [found[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return pd.DataFrame({"ids": ids, "decoded": [encoder.decode(i) for i in ids]})

    df = df.drop("ids", "decoded")
    out = free_name(df, "bpe")
    got = _over_texts(_read(tokenizer_path), make, F.col(f"`{text_column}`"), "ids array<int>, decoded string")
    near = near_by_content(df, text_column, id_column)
    return near.withColumn(out, got).select(*[F.col(f"`{c}`") for c in df.columns], f"{out}.*")


def encoding_digest(df: DataFrame, tokenizer_path: str, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The id column with ``n_tokens``, ``ids_sha256`` (hex of the decimal ids
    joined by a space) and ``decoded_sha256`` (of the decoded text) of what
    :func:`encode_documents` returns, without carrying ids out of the tasks."""

    def sha(text: bytes | memoryview) -> str:
        return hashlib.sha256(text).hexdigest()

    def make(encoder: ChunkEncoder, texts: list[str | None]) -> pd.DataFrame:
        ids, edges = encoder.encode_batch(texts)
        if encoder.names is not None:
            decoded = encoder.joined(encoder.spaced, ids, edges)
        else:
            decoded = [encoder.decode(ids[a:b].tolist()).encode("utf-8", "surrogatepass") for a, b in zip(edges[:-1], edges[1:], strict=True)]
        numbers = encoder.joined(encoder.numbers, ids, edges)
        return pd.DataFrame({"n_tokens": np.diff(edges), "ids_sha256": list(map(sha, numbers)), "decoded_sha256": list(map(sha, decoded))})

    near = near_by_content(df.select(id_column, text_column), text_column, id_column)
    got = _over_texts(_read(tokenizer_path), make, F.col(f"`{text_column}`"), "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return near.select(id_column, got.alias("bpe")).select(id_column, "bpe.*")


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
