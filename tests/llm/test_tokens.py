"""Token files against the tokenizer on whole texts, and what a read touches."""

from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rollcall.llm import queries, tokens, word_store

PATH = queries.tokenizer_path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, tokens string, part int, start int"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(13)
    pieces = ["word", "Word.", "don't", "it's,", "x's!", "12,5", "a\nb", "a \n b", "\t", "", " ", "  ", "é.", "ü!", "日本語。", "한국어.", "😀!", "<|endoftext|>", "<|endoftext|>.",
              "x<|endoftext|>y", " ", "　", "᠎", "​", "\x1c", "\x85", "ǅ.", "ʰ.", "Ⅷ.", "²", "٣", "...", "?!", "-", "--", "'", "'ll", "we'll.", "\r\n", "ß", "ı̇", "́", "é.",
              "w" * 70, "w" * 64 + ".", "�", "Ġ", "Ġa", "Ġ.", "नमस्ते", "ไทย", "ab cd"]
    out = [None, "", " ", "  ", "a", " a", "a ", " a ", "a b", "a  b", "a   b ", "\na b\n", "b \t c", ". . .", "x" * 50_000, "y " * 20_000]
    out += [rng.choice([" ", " ", "  ", "\n", " \n"]).join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(400)]
    return out


@pytest.mark.parametrize("kept", [400_000, 20])
def test_words_give_the_tokens_of_the_whole_text(plain, kept):
    encoder = tokens.WordEncoder(open(PATH, encoding="utf-8").read(), kept)
    assert encoder.by_word
    for text in texts():
        assert encoder.encode(text).tolist() == plain(text), text
    for again in range(2):  # many texts at once, with a store that holds words of theirs
        encoder = encoder if again else tokens.WordEncoder(open(PATH, encoding="utf-8").read(), kept)
        made = encoder.encode_all(texts())
        assert [np.frombuffer(m, encoder.kind).tolist() for m in made] == [plain(t) for t in texts()]


def test_words_of_letters_go_straight_to_the_model(plain, monkeypatch):
    encoder = tokens.WordEncoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(4)
    words = ["".join(rng.choices("abcXYZéÜßıÅøñĳ", k=rng.randint(1, 9))) + rng.choice(["", ".", "%%%", ",&&&", "|>", "!?"]) for _ in range(2000)]
    given = [" ".join(words[i : i + 40]) for i in range(0, len(words), 40)]
    whole = []
    monkeypatch.setattr(encoder, "_whole", lambda some, f=encoder._whole: whole.extend(some) or f(some))
    made = encoder.encode_all(given)
    assert [np.frombuffer(m, encoder.kind).tolist() for m in made] == [plain(t) for t in given]
    assert len(whole) <= len(given) + 10  # first words, and marks


def test_words_parted_by_a_line_feed_go_straight_to_the_model(plain, monkeypatch):
    encoder = tokens.WordEncoder(open(PATH, encoding="utf-8").read())
    rng = random.Random(5)
    words = ["\n".join("".join(rng.choices("abcXYZéÜßı", k=rng.randint(1, 9))) + rng.choice(["", ".", "!?"]) for _ in range(rng.randint(1, 2))) for _ in range(4000)]
    given = ["a " + " ".join(words[i : i + 40]) for i in range(0, len(words), 40)]
    whole = []
    monkeypatch.setattr(encoder, "_whole", lambda some, f=encoder._whole: whole.extend(some) or f(some))
    for _ in range(2):
        assert [np.frombuffer(m, encoder.kind).tolist() for m in encoder.encode_all(given)] == [plain(t) for t in given]
    assert sorted(whole) == ["", "!?", ".", "a"]  # marks, and the first word; no word twice


def test_word_parts_next_to_other_white_space_and_signs(plain):
    rng = random.Random(6)
    pieces = ["a.\nB", "a\nB.", "a.\n\nB", "a\n'll", "x's\nY", "ab.\n", "\nab", "Éa!\nÜb?", "a\nb\nc", "日本\nAb", "a.\r\nB", "1\nA", "A\n1", "x\n<|endoftext|>", "<|endoftext|>\nx",
              "w" * 70 + "\n" + "v" * 70, "", "ĊA", "Ċ\nA", "a\nĠ", "İ\nİ", "word", "Word"]
    given = [rng.choice([" ", " ", "  ", "\n"]).join(rng.choices(pieces, k=rng.randint(1, 30))) for _ in range(600)]
    for kept in (0, 3, 400_000):
        encoder = tokens.WordEncoder(open(PATH, encoding="utf-8").read(), kept)
        for i in range(0, len(given), 150):
            assert [np.frombuffer(m, encoder.kind).tolist() for m in encoder.encode_all(given[i : i + 150])] == [plain(t) for t in given[i : i + 150]]


@pytest.mark.parametrize("alike", [False, True])
def test_store_of_words(monkeypatch, alike):
    if alike:  # words with one hash are still told apart
        monkeypatch.setattr(word_store, "word_hashes", lambda words: np.full(len(words), 7, np.uint64))
    store = word_store.WordStore(np.dtype(np.uint16))

    def add(*words):
        found = pa.array(words, pa.string())
        return store.add(found, word_store.word_hashes(found), np.arange(len(words), dtype=np.uint16), np.ones(len(words), np.int64))

    def find(*words):
        found = pa.array(words, pa.string())
        return store.find(found, word_store.word_hashes(found)).tolist()

    assert find("a") == [-1]
    assert add("a", "", "é", "x" * 65, "b").tolist() == [0, 1, 2, 3, 4]
    assert store.tokens.to_pylist() == [[0], [1], [2], [3], [4]]
    assert find("c") == [-1] and find("x" * 64 + "y") == [-1]
    assert find("a", "c", "") == [0, -1, -1 if alike else 1]
    store.trim(10, 64)  # the long one
    assert store.words.to_pylist() == ["a", "", "é", "b"] and find("a", "x" * 65) == [0, -1]
    store.trim(10, 64)
    add("d")
    store.trim(4, 64)  # all but the half of four that was used last
    assert store.words.to_pylist() == ["a", "d"] and store.tokens.to_pylist() == [[0], [0]]
    assert find("d", "é") == [1, -1]


def test_new_words_reach_the_model_a_few_groups_at_a_time(plain):
    encoder = tokens.WordEncoder(open(PATH, encoding="utf-8").read())
    model, calls = encoder.letters.model, []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return model.encode_batch_fast(texts, **options)

    encoder.letters.model = Counted()
    letters = "abcdefghijéü"
    words = ["".join(letters[int(d)] for d in str(n)) + letters[n % 12] for n in range(25_000)]
    found = dict(encoder.letters.ids(words))
    assert sum(calls) == 25_000 // 500 and max(calls) <= 20
    assert [np.frombuffer(found[w], encoder.kind).tolist() for w in words[::97]] == [plain(" " + w) for w in words[::97]]


def test_memory_of_encoded_texts_is_given_back(spark, monkeypatch):
    # where the tasks' function runs in this process, so that what it frees can be seen
    seen = []
    monkeypatch.setattr(tokens, "give_back", lambda: seen.append(1))
    monkeypatch.setattr(tokens, "BATCH_BYTES", 100)

    class Rows:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([0, 0, 0], pa.int32()), pa.array(["a b " * 30, None, "c " * 60])], ["doc_id", "part", "text"])
            return list(run(iter([batch])))

    made = tokens.encode_in_order(Rows(), PATH, 2)
    assert sum(b.num_rows for b in made) == 3 and len(seen) == len(made) == 2


def test_other_tokenizers_encode_texts_whole():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    encoder, other = tokens.WordEncoder(open(path, encoding="utf-8").read()), Tokenizer.from_file(path)
    assert not encoder.by_word
    for text in texts()[:80]:
        assert encoder.encode(text).tolist() == other.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rows():
    given = texts()
    out = [(7 * i % 501 if i % 40 else None, t) for i, t in enumerate(given)]
    return out + [(11, "the same row")] * 150 + [(12, t) for t in given[20:60]]


@pytest.fixture(scope="module")
def store(spark, rows, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('tokens')}/store"
    df = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows], DOCS).repartition(3)
    return tokens.write_tokens(df, path, PATH, parts=5, page_rows=20, row_group_bytes=1 << 17)


def test_round_trip(spark, rows, store, plain):
    got = tokens.read_documents(spark, store).collect()
    ids = {t: [*plain(t), 2] for _, t in rows}
    assert sorted((i is not None, i or 0, *ids[t]) for i, t in rows) == sorted((r.doc_id is not None, r.doc_id or 0, *r.tokens) for r in got)
    got.sort(key=lambda r: r.start)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)  # ascending ids, null first
    assert [r.start for r in got] == np.cumsum([0, *[len(r.tokens) for r in got]])[:-1].tolist()
    assert all(r.n_tokens == len(r.tokens) for r in got)
    parts = tokens.read_parts(spark, store).orderBy("part").collect()
    assert len(parts) == 5 and sum(p.n_docs for p in parts) == len(rows)  # 150 equal rows do not make one range of theirs
    digest = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in tokens.token_digest(tokens.read_documents(spark, store)).collect()}
    assert digest == {(r.doc_id, r.start): (len(r.tokens), zlib.crc32(np.array(r.tokens, "<u4").tobytes())) for r in got}


def test_selective_reads(spark, rows, store):
    all_rows = sorted(tokens.read_documents(spark, store).collect(), key=lambda r: r.start)
    stream = [t for r in all_rows for t in r.tokens]
    some = tokens.read_documents(spark, store, 100, 120)
    assert sorted(some.collect(), key=lambda r: r.start) == [r for r in all_rows if r.doc_id is not None and 100 <= r.doc_id <= 120]
    plan = some._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan
    lengths = tokens.read_documents(spark, store).select("doc_id", "n_tokens")
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan  # no token is read for metadata
    for start, length in [(0, 1), (5, 300), (1000, 40_000), (len(stream) - 3, 100), (len(stream), 5), (17, 0)]:
        pieces = sorted(tokens.read_span(spark, store, start, length).collect(), key=lambda r: r.start)
        assert [t for r in pieces for t in r.tokens] == stream[start : start + length]
        if pieces:
            assert pieces[0].start == start


@pytest.mark.parametrize("encoding,name", [("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_encodings_row_groups_and_page_indexes(spark, tmp_path, encoding, name):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = tokens.write_tokens(df, f"{tmp_path}/store", PATH, encoding=encoding, parts=1, row_group_bytes=1 << 20, page_rows=100)
    (file,) = glob.glob(f"{path}/tokens/*.parquet")
    meta = pq.ParquetFile(file).metadata
    assert meta.num_row_groups > 1
    for g in range(meta.num_row_groups):
        columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
        assert name in columns["tokens.list.element"].encodings
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
        assert columns["doc_id"].statistics.min <= columns["doc_id"].statistics.max


def test_empty_table_and_bad_encoding(spark, tmp_path):
    path = tokens.write_tokens(spark.createDataFrame([], DOCS), f"{tmp_path}/store", PATH)
    assert tokens.read_documents(spark, path).collect() == [] and tokens.token_digest(tokens.read_documents(spark, path)).collect() == []
    assert tokens.read_span(spark, path, 0, 10).collect() == []
    with pytest.raises(ValueError, match="dictionary or delta"):
        tokens.write_tokens(spark.createDataFrame([(1, "a", "", 1, 1)], DOCS), f"{tmp_path}/other", PATH, encoding="none")


def test_query_on_the_given_table(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, start = {}, 0
    for i, t in docs:
        ids = [*plain(t), 2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    got = queries.op13_token_files(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want
    assert got.select(F.count_distinct("doc_id")).first()[0] == len(docs)
