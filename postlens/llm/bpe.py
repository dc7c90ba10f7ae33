"""Encoding and decoding with a published byte-pair vocabulary that marks word ends.

The distinct words of a batch form one flat list of symbols. An index maps each pair of
neighbours that has a merge to all its positions; a heap holds the ranks of the pairs
that occur. The smallest active rank is applied at all its positions at once, and
only the pairs next to them change lists. The ids of every word are then put in the
order of the texts. A task remembers the strings between spaces it has met, up to a number
of bytes, so a frequent word is merged once; nothing is kept after the task.

The vocabulary is read by its path on the driver and sent to the tasks; its size does
not depend on the data.

Edge cases: a null text is empty and has no ids. A special token's exact string in a
text becomes its id. A text is cut at spaces, between words, into segments, so a very
long one needs no more than its own length in memory; a very long string without spaces is
forgotten once it is encoded. Only id and text are read, so
other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import lean, payload, smaller

SEGMENT = 1 << 20
FLUSH_STRINGS = 1 << 17
KNOWN_BYTES = 96 << 20
# A string as an object and dictionary key with its places, besides its characters.
STRING_BYTES = 200
TEXT_BYTES = 1 << 20
# White space and words as the vocabulary's own file defines them.
_SPACE = re.compile("[\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^ \p{L}\p{N}]+")


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    def __init__(self, definition: str):
        said = json.loads(definition)
        model = said["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.end = model["end_of_word_suffix"] or ""
        self.strings = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        listed = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.pairs = [(self.ids[a], self.ids[b]) for a, b in listed]
        self.made = [self.ids[a + b] for a, b in listed]
        self._check_order()
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        self._rank = np.argsort(keys)
        self._key = keys[self._rank]
        signs = byte_symbols()
        self.inner = np.array([self.ids.get(signs[b], -1) for b in range(256)], np.int64)
        self.last = np.array([self.ids.get(signs[b] + self.end, -1) for b in range(256)], np.int64)
        found = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.split = regex.compile(f"({found})") if found else None

    def _check_order(self) -> None:
        """A symbol must be made before it is merged: then no merge makes a pair of smaller rank,
        and all positions of the smallest rank can be merged at once."""
        made: dict[int, int] = {}
        for rank, symbol in enumerate(self.made):
            made[symbol] = rank
        if any(made.get(x, -1) >= rank for rank, pair in enumerate(self.pairs) for x in pair):
            raise ValueError("the merges use a symbol before they make it")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols, -1 for those without a merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self._key, key), len(self._key) - 1)
        return np.where(self._key[at] == key, self._rank[at], -1)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words as symbols of bytes, the last of each marked, and each word's number of them."""
        data = [w.encode("utf-8", "replace") for w in words]
        size = np.fromiter(map(len, data), np.int64, len(data))
        codes = np.frombuffer(b"".join(data), np.uint8)
        out = self.inner[codes]
        ends = np.cumsum(size) - 1
        out[ends] = self.last[codes[ends]]
        if (out < 0).any():  # a vocabulary may lack a byte; it is left out
            size = np.bincount(np.repeat(np.arange(len(size)), size)[out >= 0], minlength=len(size))
            out = out[out >= 0]
        return out, size


def _firsts(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Positions of a pair of equal symbols that do not overlap one taken further left."""
    taken: set[int] = set()
    keep = np.zeros(len(at), bool)
    for i, (place, right) in enumerate(zip(at.tolist(), after[at].tolist())):
        if place not in taken:
            keep[i] = True
            taken.add(right)
    return at[keep]


def merge_words(words: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and how many each word has.

    The words are merged together through an index of pair positions.
    """
    symbol, size = vocabulary.symbols(words)
    word = np.repeat(np.arange(len(size)), size)
    n = len(symbol)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    ends = np.cumsum(size)[size > 0]
    after[ends - 1] = -1
    before[(ends - size[size > 0])] = -1

    places: dict[int, list[np.ndarray]] = {}  # rank -> positions of the left symbol of its pair
    active: list[int] = []

    def note(at: np.ndarray) -> int:
        """Index the pairs that start there; gives the smallest of their ranks."""
        rank = vocabulary.ranks(symbol[at], symbol[after[at]])
        found = rank >= 0
        if not found.any():
            return len(vocabulary.pairs)
        at, rank = at[found], rank[found]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, part in zip(rank[np.r_[0, cuts]].tolist(), np.split(at, cuts)):
            if r in places:
                places[r].append(part)
            else:
                places[r] = [part]
                heapq.heappush(active, r)
        return int(rank[0])

    if n:
        note(np.flatnonzero(after >= 0))
    while active:
        rank = heapq.heappop(active)
        a, b = vocabulary.pairs[rank]
        parts = places.pop(rank)
        at = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        at = at[(symbol[at] == a) & (after[at] >= 0)]
        at = at[symbol[after[at]] == b]
        if a == b:
            at = _firsts(np.sort(at), after)
        if not len(at):
            continue
        right = after[at]
        far = after[right]
        symbol[at], symbol[right] = vocabulary.made[rank], -1
        after[at] = far
        before[far[far >= 0]] = at[far >= 0]
        left = before[at]
        note(np.concatenate([left[left >= 0], at[far >= 0]]))
    kept = symbol >= 0
    return symbol[kept].astype(np.uint32), np.bincount(word[kept], minlength=len(size))


def _lowered(text: str) -> str:
    """Normal form, white space as spaces, each character lowered by itself."""
    return _SPACE.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()


def _words(string: str) -> list[str]:
    """The words of a string without spaces; letters with one full stop or comma need no pattern."""
    if string.isalpha():
        return [string]
    if string[-1:] in (".", ",") and string[:-1].isalpha():
        return [string[:-1], string[-1]]
    return _WORD.findall(string)


def pieces(text: str, vocabulary: Vocabulary) -> Iterator[int | list[str]]:
    """Special ids, and lists of the strings between spaces, in order."""
    for part in vocabulary.split.split(text) if vocabulary.split else [text]:
        if part in vocabulary.special:
            yield vocabulary.special[part]
            continue
        part = _lowered(part)
        at = 0
        while at < len(part):
            end = part.find(" ", at + SEGMENT)
            end = len(part) if end < 0 else end
            yield part[at:end].split(" ")
            at = end


def _gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices of `flat` one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - length), length) + np.arange(total)]


class Encoder:
    """Encodes texts, keeping the ids of the strings between spaces that it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.held = 0
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    def learn(self, strings: Iterable[str]) -> None:
        met = set(strings)
        new = sorted(met.difference(self.place))
        if not new:
            return
        if self.held > KNOWN_BYTES:
            self.forget()
            new = sorted(met)
        # Four bytes a character at most, and as many ids as bytes.
        self.held += sum(STRING_BYTES + 8 * len(s) for s in new)
        words = [_words(s) for s in new]
        known = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
        ids, size = merge_words(list(known), self.vocabulary)
        first = np.cumsum(size) - size
        order = np.array([known[w] for ws in words for w in ws], np.int64)
        flat = _gathered(ids, first[order], size[order])
        owner = np.repeat(np.arange(len(new)), [len(ws) for ws in words])
        length = np.bincount(owner, size[order], minlength=len(new)).astype(np.int64)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, flat])
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(number of the text, ids) in order; a text may come in several parts."""
        waiting: list[tuple[int, int | list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for piece in pieces(text, self.vocabulary):
                waiting.append((i, piece))
                size += len(piece) if isinstance(piece, list) else 1
                if size > FLUSH_STRINGS:
                    yield from self._flush(waiting)
                    waiting, size = [], 0
        yield from self._flush(waiting)

    def _flush(self, waiting: list[tuple[int, int | list[str]]]) -> Iterator[tuple[int, np.ndarray]]:
        self.learn(w for _, piece in waiting if isinstance(piece, list) for w in piece)
        for i, piece in waiting:
            if not isinstance(piece, list):
                yield i, np.array([piece], np.uint32)
                continue
            at = np.fromiter(map(self.place.__getitem__, piece), np.int64, len(piece))
            yield i, _gathered(self.flat, self.start[at], self.length[at])
        if self.held > KNOWN_BYTES:
            self.forget()


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The tokens' strings, joined by spaces as a vocabulary without a decoder has it."""
    return " ".join(map(vocabulary.strings.__getitem__, ids))


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(
    docs: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256) for every row, `ids` on demand."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(definition)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), payload(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        encoder = Encoder(vocabulary)
        for batch in smaller(batches, "text", TEXT_BYTES):
            texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
            count = [0] * len(texts)
            all_ids: list[list[np.ndarray]] = [[] for _ in texts]
            of_ids = [hashlib.sha256() for _ in texts]
            of_text = [hashlib.sha256() for _ in texts]
            for i, ids in encoder.encode(texts):
                if not len(ids):
                    continue
                of_ids[i].update(ids.astype("<u4").tobytes())
                if count[i]:
                    of_text[i].update(b" ")
                of_text[i].update(decode(ids.tolist(), vocabulary).encode())
                count[i] += len(ids)
                if with_ids:
                    all_ids[i].append(ids)
            columns = [batch.column("doc_id"), pa.array(count, pa.int64())]
            if with_ids:
                columns.append(pa.array([np.concatenate(x) if x else [] for x in all_ids], pa.list_(pa.int32())))
            columns += [pa.array([h.hexdigest() for h in hs], pa.string()) for hs in (of_ids, of_text)]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(lean(encoded), schema)
