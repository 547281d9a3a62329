"""Token ids as Parquet files that can be read in part.

A token store is a folder of two tables:

* ``tokens``: one row per document in ascending id order over all files, with
  ``doc_id, part, start, n_tokens, tokens`` (a list of int). ``start`` counts
  from the first token of the file's ``part``. Ids of tokens are written with a
  dictionary or as bit-packed deltas, the number columns as deltas. Row groups
  are closed at a set size and pages at a set number of rows, and Parquet
  keeps smallest and largest values of each page in its page index. So a read
  of a few documents touches the pages that hold them, and a read of lengths
  or places touches no token.
* ``parts``: a row per file with its id range, number of documents and tokens,
  and the store's position of its first token. It is written last: a folder
  without it is not a complete store.

Texts are shuffled once, to ranges of ids; they are encoded where they are
written. A tokenizer whose pre-tokens never cross a single space gets each
distinct word once per worker (the store of words is bounded).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .letters import LETTERS, TOGETHER, LetterWords, letters_stay, pieces, utf8
from .staging import give_back, shuffle_partitions, worker_state
from .word_store import WordStore, word_hashes

WORDS_KEPT = 300_000
LONGEST_WORD = 64  # bytes; longer words are encoded each time
#: Bytes of text that are encoded and handed to Spark together.
BATCH_BYTES = 2 << 20
#: Parts up to which their table is broadcast (24 bytes a row).
PARTS_BROADCAST = 1_000_000

TOKENS_SCHEMA = "doc_id long, part int, start long, n_tokens long, tokens array<int>"
PARTS_SCHEMA = "part int, first_id long, last_id long, n_docs long, n_tokens long, part_start long"

_WHITE = [chr(c) for c in range(0x3001) if chr(c).isspace() or c == 0x180E]  # (U+180E was white space in older tables)
_ODD = ["  ", *(f for c in _WHITE if c != " " for f in (" " + c, c + " "))]  # spaces where a pre-token need not begin
_ODD_ASCII = [f for f in _ODD if f.isascii()]
_CUT = re.compile(f"(?<![{''.join(_WHITE)}]) (?![{''.join(_WHITE)}])(?<!^ )(?!$)")
_WHITE_BYTE, _WIDE_LEAD = np.zeros(256, bool), np.zeros(256, bool)
_WHITE_BYTE[[ord(c) for c in _WHITE if c.isascii()]] = True
_WIDE_LEAD[[c.encode()[0] for c in _WHITE if len(c.encode()) == 3]] = True


class WordEncoder:
    """Encodes texts exactly as ``tokenizers`` does for the whole text, without
    special tokens being added."""

    def __init__(self, tokenizer_json: str, words_kept: int = WORDS_KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        spec = json.loads(tokenizer_json)
        spec["truncation"] = spec["padding"] = None
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.words_kept = words_kept
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        top = max(vocabulary.values(), default=0)
        self.kind = np.dtype(np.uint16 if top < 1 << 16 else np.uint32)
        self.by_word = _parts_at_space(spec)
        self.store = WordStore(self.kind)
        self.opens = np.zeros(top + 1, bool)  # tokens that begin with the space
        for name, i in vocabulary.items():
            self.opens[i] = name.startswith("Ġ")
        self.letters = LetterWords(self.tokenizer, "Ġ", self.opens, self.kind) if self.by_word and letters_stay(spec) else None
        feed = np.zeros(top + 1, bool)
        feed[vocabulary.get("Ċ", 0)] = True
        self.lines = LetterWords(self.tokenizer, "Ċ ", feed, self.kind) if self.letters and "Ċ" in vocabulary else None

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _after_space(self, words: list[str]) -> list[bytes]:
        """Tokens of each word, given with a space before it and none in it."""
        out = []
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, raw in zip(groups, self._whole(list(map("".join, groups))), strict=True):
            at = np.flatnonzero(self.opens[np.frombuffer(raw, self.kind)])
            if len(at) != len(group) or at[0]:
                raise ValueError("a word's tokens do not begin with its space")
            edges = [*(at * self.kind.itemsize).tolist(), len(raw)]
            out += [raw[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        return out

    def _tokens(self, words: pa.Array, spaced: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all ``words`` in a row, how many each one has, and the
        order of the words in that. ``spaced``: each has a space before it that
        begins a pre-token, and no space around it would change its tokens."""
        rest, order, tokens, sizes = np.ones(len(words), bool), [], [], []
        for model, first in ((self.letters, " "), (self.lines, "\n")):
            if model:
                fits = pa.compute.match_substring_regex(words, f"^{first}[{LETTERS}]+$").to_numpy(zero_copy_only=False)
                rest &= ~fits
                order.append(np.flatnonzero(fits))
                made, size = model.arrays(words.take(pa.array(order[-1])), first)
                tokens.append(made)
                sizes.append(size)
        at = np.flatnonzero(rest)
        given = words.take(pa.array(at)).to_pylist()
        single = np.array([spaced and " " not in w[1:] for w in given], bool)
        order += [at[single], at[~single]]
        raw = self._after_space(list(compress(given, single))) + self._whole(list(compress(given, ~single)))
        tokens.append(np.frombuffer(b"".join(raw), self.kind))
        sizes.append(np.array([len(r) for r in raw], np.int64) // self.kind.itemsize)
        return np.concatenate(tokens), np.concatenate(sizes), np.concatenate(order)

    def _rows(self, words: pa.Array, spaced: bool) -> np.ndarray:
        """Rows of distinct ``words`` in the store, which learns the new ones."""
        hashes = word_hashes(words)
        rows = self.store.find(words, hashes)
        new = np.flatnonzero(rows < 0)
        if len(new):
            tokens, sizes, order = self._tokens(words.take(pa.array(new)), spaced)
            new = new[order]
            rows[new] = self.store.add(words.take(pa.array(new)), hashes[new], tokens, sizes)
        return rows

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in a row, and where each text's begin (and the
        last one's end). Words are split, numbered, looked up and replaced by
        their tokens as Arrow arrays; only distinct pieces of them are looked up."""
        texts = pa.compute.fill_null(texts, "")
        given = texts.to_pylist()
        if not self.by_word:
            made = self._whole(given)
            return np.frombuffer(b"".join(made), self.kind), np.cumsum([0, *[len(m) // self.kind.itemsize for m in made]])
        odd = np.zeros(len(given), bool)
        doubtful = _spaces_may_meet(texts)
        odd[doubtful] = [_spaces_meet(given[i]) for i in doubtful]
        if not odd.any():
            return self._of_words(pa.compute.split_pattern(texts, " "))
        # the others first, then the odd ones, whose tokens go back to their places
        split = pa.compute.split_pattern(texts.filter(pa.array(~odd)), " ")
        cut = pa.array([_CUT.split(t) for t in compress(given, odd)], split.type)
        tokens, edges = self._of_words(pa.concat_arrays([split, cut]))
        back = np.argsort(np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)]))
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(tokens)).take(pa.array(back))
        return lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)

    def _of_words(self, words: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """``encode_batch`` for the words of each text (one at least)."""
        edges = words.offsets.to_numpy().astype(np.int64)
        coded = words.values.dictionary_encode()
        at, distinct = coded.indices.to_numpy().copy(), coded.dictionary
        # the first word of a text has no space before it
        firsts, own = np.unique(at[edges[:-1]], return_inverse=True)
        at[edges[:-1]] = len(distinct) + own
        used = np.flatnonzero(np.bincount(at, minlength=len(distinct))[: len(distinct)])
        stems, others = distinct.take(pa.array(used)), []
        if self.letters:
            stems, *others = pieces(stems)
        stems = stems.dictionary_encode()
        loose = pa.concat_arrays([pa.array([""], pa.string()), *others, distinct.take(pa.array(firsts))]).dictionary_encode()
        stem = self._rows(pa.compute.binary_join_element_wise(" ", stems.dictionary, ""), True)[stems.indices.to_numpy()]
        rows = self._rows(loose.dictionary, False)[loose.indices.to_numpy()]
        # every word is the tokens of so many pieces (row 0 of the loose ones has none)
        place = np.full((len(distinct) + len(firsts), 1 + len(others)), rows[0])
        place[used] = np.column_stack([stem, *np.split(rows[1 : len(rows) - len(firsts)], len(others) or 1)][: 1 + len(others)])
        place[len(distinct) :, 0] = rows[len(rows) - len(firsts) :]
        parts = self.store.tokens.take(pa.array(place.ravel()))
        lists = pa.ListArray.from_arrays(parts.offsets.take(pa.array(np.arange(0, place.size + 1, place.shape[1]))), parts.values)
        self.store.trim(self.words_kept, LONGEST_WORD)
        taken = lists.take(pa.array(at))
        return taken.values.to_numpy(), taken.offsets.to_numpy().astype(np.int64)[edges]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """The tokens of each text, as packed unsigned integers."""
        tokens, edges = self.encode_batch(pa.array(texts, pa.string()))
        return [tokens[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_batch(pa.array([text], pa.string()))[0]


def _spaces_may_meet(texts: pa.Array) -> np.ndarray:
    """Numbers of the texts that hold a space at an end, or next to a byte that
    white space can begin or end with."""
    raw, edges = utf8(texts)
    if not len(raw):
        return np.empty(0, np.int64)
    near = np.concatenate([np.full(3, 32, np.uint8), raw, np.full(1, 32, np.uint8)])
    at = np.flatnonzero(raw == 32)
    before, after = near[at + 2], near[at + 4]
    wide = (before >= 0x80) & ((near[at + 1] == 0xC2) | _WIDE_LEAD[near[at]])
    doubt = at[_WHITE_BYTE[before] | wide | _WHITE_BYTE[after] | _WIDE_LEAD[after] | (after == 0xC2)]
    ends = np.flatnonzero(np.diff(edges))
    ends = ends[(raw[edges[ends]] == 32) | (raw[edges[ends + 1] - 1] == 32)]
    return np.union1d(np.searchsorted(edges, doubt, "right") - 1, ends)


def _spaces_meet(text: str) -> bool:
    """True where some space is at an end of the text or next to white space."""
    return text[0] == " " or text[-1] == " " or any(map(text.__contains__, _ODD_ASCII if text.isascii() else _ODD))


def _parts_at_space(spec: dict) -> bool:
    """True for byte-level BPE with the usual pattern and nothing before it:
    a pre-token then begins at every space between two characters that are no
    white space, and knows nothing of what is before it."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    alone = all(not t["lstrip"] and not t["rstrip"] and not t["single_word"] and not re.search(r"\s", t["content"])
                for t in spec.get("added_tokens", []))
    return (alone and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and model.get("type") == "BPE" and not model.get("dropout"))


def in_id_order(df: DataFrame, parts: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text`` in ``parts`` ranges of ascending ids (null first), each
    sorted; rows of one id by text hash and then as they come, so a range can
    end within an id or a group of equal rows."""
    rows = df.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("turn", F.monotonically_increasing_id())
    order = ["doc_id", "tie", "turn"]
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")


def encode_in_order(ordered: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    """The rows of ``tokens`` (see the module) for :func:`in_id_order`'s rows."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("tokens", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one encoder a worker process: later tasks go on with the words that it knows
        name = f"tokens-{zlib.crc32(spec.encode())}-{len(spec)}"
        encoder = worker_state().get(name) or worker_state().setdefault(name, WordEncoder(spec))
        position = 0
        for batch in batches:
            texts = batch.column(2)
            for begin, stop in _groups(texts):
                made, edges = encoder.encode_batch(texts.slice(begin, stop - begin))
                if end_id is not None:
                    made = np.insert(made.astype(np.int32), edges[1:], end_id)
                    edges = edges + np.arange(len(edges))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(made.astype(np.int32, copy=False)))
                columns = [*(batch.column(c).slice(begin, stop - begin) for c in (0, 1)), pa.array(position + edges[:-1]), pa.array(np.diff(edges)), lists]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
                position += int(edges[-1])
                del made, edges, lists, columns
                give_back()

    return ordered.select("doc_id", F.spark_partition_id().alias("part"), "text").mapInArrow(run, TOKENS_SCHEMA)


def _groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Rows in groups of about ``BATCH_BYTES`` of text."""
    size = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0), np.int64))
    begin = 0
    while begin < len(texts):
        stop = int(np.searchsorted(size, (size[begin - 1] if begin else 0) + BATCH_BYTES)) + 1
        yield begin, min(stop, len(texts))
        begin = stop


def file_options(encoding: str, vocabulary: int, row_group_bytes: int, page_rows: int) -> dict[str, str]:
    """Options of Spark's Parquet writer for a token store."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding is dictionary or delta, not {encoding!r}")
    return {
        "compression": "zstd",
        "parquet.writer.version": "v2",  # numbers without a dictionary are written as deltas
        "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
        "parquet.dictionary.page.size": str(max(1 << 20, 8 * vocabulary)),
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.page.size": str(1 << 18),
    }


def write_tokens(
    df: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = 2,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_rows: int = 256,
    parts: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Write the token store of ``df`` at ``path``, which must not exist.

    Every row gives one document: the ids of ``tokenizers`` for the whole text
    (no special tokens added, no truncation or padding), then ``end_id``. A null
    or empty text has only the end id. Null ids come first; rows of one id
    follow each other by text hash, equal rows count one each. An empty table
    gives a store without documents. Other columns are not read.
    """
    spark = df.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = len(json.load(f).get("model", {}).get("vocab", ()))
    rows = encode_in_order(in_id_order(df, parts or shuffle_partitions(spark), id_column, text_column), tokenizer_path, end_id)
    rows.write.options(**file_options(encoding, vocabulary, row_group_bytes, page_rows)).parquet(f"{path}/tokens")
    stored = spark.read.schema(TOKENS_SCHEMA).parquet(f"{path}/tokens")
    found = stored.groupBy("part").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    rows, position = [], 0
    for r in found.orderBy("part").collect():  # one row per file
        rows.append((*r, position))
        position += r["n_tokens"]
    spark.createDataFrame(rows, PARTS_SCHEMA).coalesce(1).write.parquet(f"{path}/parts")
    return path


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS_SCHEMA).parquet(f"{path}/parts")


def read_documents(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``doc_id, start, n_tokens, tokens`` of the documents with ids from
    ``first`` to ``last`` (both included; ``None``: no bound), ``start`` counted
    over the whole store. The bounds reach the page index; select fewer
    columns and no others are read."""
    rows = spark.read.schema(TOKENS_SCHEMA).parquet(f"{path}/tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    places = read_parts(spark, path).select("part", "part_start")
    if places.count() <= PARTS_BROADCAST:
        places = F.broadcast(places)
    return rows.join(places, "part").select("doc_id", (F.col("part_start") + F.col("start")).alias("start"), "n_tokens", "tokens")


def read_span(spark: SparkSession, path: str, start: int, length: int) -> DataFrame:
    """The tokens at positions ``start`` to ``start + length`` of the store, as
    ``doc_id, start, tokens`` with the pieces of the documents they are from
    (``start``: position of the piece). Only files, and in the first and last of
    them only pages, that the span touches are read."""
    stop = start + length
    touched = read_parts(spark, path).where((F.col("part_start") < stop) & (F.col("part_start") + F.col("n_tokens") > start))
    ends = touched.agg(F.min_by(F.struct("part", "part_start"), "part").alias("a"), F.max_by(F.struct("part", "part_start"), "part").alias("b")).first()
    rows = spark.read.schema(TOKENS_SCHEMA).parquet(f"{path}/tokens")
    a, b = ends["a"], ends["b"]
    if a is None or length <= 0:
        inside = F.lit(False)
    else:
        inside = F.col("part").between(a["part"], b["part"])
        # within the outer files, by places in the file
        inside &= (F.col("part") > a["part"]) | (F.col("start") + F.col("n_tokens") > start - a["part_start"])
        inside &= (F.col("part") < b["part"]) | (F.col("start") < stop - b["part_start"])
    at = F.col("part_start") + F.col("start")
    skip = F.greatest(F.lit(start) - at, F.lit(0))
    size = F.least(F.lit(stop) - at, F.col("n_tokens")) - skip
    rows = rows.where(inside).join(touched.select("part", "part_start"), "part")
    return rows.select("doc_id", (at + skip).alias("start"), F.slice("tokens", (skip + 1).cast("int"), F.greatest(size, F.lit(0)).cast("int")).alias("tokens"))


def token_digest(documents: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of rows of :func:`read_documents`:
    the number of ids read and the CRC-32 of them as little-endian 32-bit
    integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            edges = lists.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.asarray(lists.values, "<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(edges)), pa.array(crc, pa.int64())], schema=schema)

    return documents.select("doc_id", "start", "tokens").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored_tokens(df: DataFrame, tokenizer_path: str, **params) -> DataFrame:
    """The rows of a token store of ``df`` written under the shared checkpoint
    folder, read back."""
    spark = df.sparkSession
    return read_documents(spark, write_tokens(df, scratch_path(spark, "token-store"), tokenizer_path, **params))
