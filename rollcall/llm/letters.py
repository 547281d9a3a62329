"""New words of a byte-level BPE tokenizer, straight from its model.

A word of letters is one pre-token. Where that is known, what stands before the
model (patterns, normal forms) can be left out: the words go to the model in
the characters that byte-level BPE has for bytes, many in one string.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - used as pa.compute

#: Words given to the tokenizer as one string.
TOGETHER = 500
#: Strings given to the tokenizer in one call; what it returns takes some hundred bytes a token.
CALLED = 20
#: Letters that have the same lower case and normal form everywhere, and that no
#: pattern tells apart.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: ASCII punctuation without the apostrophe of contractions.
MARKS = r"!-&(-/:-@\[-`{-~"
_WORD = f"^(?P<stem>[{LETTERS}]+)(?P<marks>[{MARKS}]*)$"
_LINES = f"^(?P<stem>[{LETTERS}]+)(?P<marks>[{MARKS}]*)(?:(?P<next>\n[{LETTERS}]+)(?P<more>[{MARKS}]*))?$"
_STEM = re.compile(f"[{LETTERS}]+")


def _byte_chars() -> dict[int, str]:
    """The characters of byte-level BPE for bytes from 128, by byte."""
    plain = [*range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain and not 0x21 <= b <= 0x7E]
    return {b: chr(256 + i) for i, b in enumerate(moved) if b >= 0x80}


_BYTE_CHARS = _byte_chars()
#: The character of every byte, as UTF-16.
_BYTE_UTF16 = np.array([ord(_BYTE_CHARS.get(b, chr(b))) for b in range(256)], "<u2")


def of_letters(word: str) -> bool:
    return _STEM.fullmatch(word) is not None


def stems_and_marks(words: pa.Array, lower: bool) -> tuple[pa.Array, pa.Array]:
    """``words`` as pieces that many words share: letters (in lower case, for a
    tokenizer that makes them so) and the punctuation behind them, which is a
    pre-token of its own. Other words are left as they are, without marks."""
    found = pa.compute.extract_regex(words, _WORD)
    stems, marks = found.field("stem"), found.field("marks")
    if found.null_count:
        known = found.is_valid()
        marks = pa.compute.if_else(known, marks, "")
        return pa.compute.if_else(known, pa.compute.utf8_lower(stems) if lower else stems, words), marks
    return pa.compute.utf8_lower(stems) if lower else stems, marks


def pieces(words: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """``words`` as the pieces of them that are pre-tokens whatever is around
    them: letters, the punctuation behind them, and of a word that a line feed
    parts also the line feed with the letters behind it, and their punctuation.
    Other words are left as they are, with empty pieces."""
    found = pa.compute.extract_regex(words, _LINES)
    stem, *more = (found.field(n) for n in ("stem", "marks", "next", "more"))
    if found.null_count:
        known = found.is_valid()
        return pa.compute.if_else(known, stem, words), *(pa.compute.if_else(known, x, "") for x in more)
    return stem, *more


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts (none null) in a row, and where each one begins."""
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    edges = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[edges[0] : edges[-1]], edges - edges[0]


def strings(texts: pa.Array) -> list[str]:
    """``to_pylist`` for many short texts."""
    raw, edges = utf8(texts)
    joined = raw.tobytes().decode()
    if len(joined) < len(raw):  # places in characters, not bytes
        edges = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[edges]
    at = edges.tolist()
    return [joined[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


class LetterWords:
    """Ids of words for which :func:`of_letters` holds, equal to those of
    ``tokenizer`` for each of them alone, or with ``lead`` before it.
    ``edges``: by id, whether a token begins a word (with a ``lead``) or ends
    one (without)."""

    def __init__(self, tokenizer, lead: str, edges: np.ndarray, kind: np.dtype) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self.lead, self.edges, self.kind = lead, edges, np.dtype(kind)

    def ids(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each word and its ids, as packed numbers."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, (ids, bounds) in zip(groups, self._found(map(" ".join, groups), map(len, groups), " "), strict=True):
            raw, at = ids.tobytes(), (bounds * self.kind.itemsize).tolist()
            yield from ((w, raw[a:b]) for w, a, b in zip(group, at[:-1], at[1:], strict=True))

    def arrays(self, words: pa.Array, first: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each one has. The words
        are given with the one character ``first`` before each of them, which
        ``lead`` stands for."""
        raw, edges = utf8(words)
        begins = range(0, len(words), TOGETHER)
        stops = [min(i + TOGETHER, len(words)) for i in begins]
        texts = (raw[edges[a] + 1 : edges[b]].tobytes().decode() for a, b in zip(begins, stops, strict=True))
        found = list(self._found(texts, (b - a for a, b in zip(begins, stops, strict=True)), first))
        if not found:
            return np.empty(0, self.kind), np.empty(0, np.int64)
        return np.concatenate([ids for ids, _ in found]), np.concatenate([np.diff(bounds) for _, bounds in found])

    def _found(self, texts: Iterable[str], counts: Iterable[int], between: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text of so many words, with ``between`` between them: its
        ids, and where each word's begin (and the last one's end)."""
        for given in batched(zip(texts, counts, strict=True), CALLED):
            found = self.model.encode_batch_fast([self._chars(t, between) for t, _ in given], add_special_tokens=False)
            for (_, count), e in zip(given, found, strict=True):
                ids = np.array(e.ids, self.kind)
                at = np.flatnonzero(self.edges[ids])
                bounds = np.append(at, len(ids)) if self.lead else np.insert(at + 1, 0, 0)
                if len(at) != count or bounds[0] or bounds[-1] != len(ids):
                    raise ValueError("a word's tokens are not where it begins or ends")
                yield ids, bounds

    def _chars(self, joined: str, between: str) -> str:
        if not joined.isascii():
            joined = _BYTE_UTF16[np.frombuffer(joined.encode(), np.uint8)].tobytes().decode("utf-16-le")
        return self.lead + joined.replace(between, " " + self.lead)


def letters_stay(spec: dict) -> bool:
    """True where no added token can be found in letters with marks behind them,
    and the model is a BPE that has every character of bytes."""
    model = spec.get("model") or {}
    end = model.get("end_of_word_suffix") or ""
    chars = [chr(b) if b < 0x80 else _BYTE_CHARS.get(b, chr(b)) for b in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100))]
    vocabulary = model.get("vocab") or {}
    return (model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
            and all(c in vocabulary and c + end in vocabulary for c in chars)
            and not any(re.fullmatch(rf"[^\W\d_]*[{MARKS}]*", t["content"]) for t in spec.get("added_tokens", [])))
