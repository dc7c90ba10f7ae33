"""Exact Jaccard self-join on word n-grams by set-relation skipping.

A document's set holds 64-bit hashes of its word n-grams; documents with equal sets are
one set from the start. Two sets that reach the threshold share a gram among the first
few of each (their prefixes) in any common order. Grams that very many documents share
go last in that order: a bounded table of the most frequent ones is counted over all
documents and sent to the tasks. The order only decides how many candidates there are.

1. Index lists: gram -> sets with it in their prefix, with size and position. Entries
   without a partner of a size that can link fall away. A list is ordered by bands of
   size, then by position, and cut in blocks; a probe skips every block in which no size
   fits or whose earliest position leaves too few grams for the overlap. In the blocks
   it opens, a pair is skipped by its own sizes and positions, and by a histogram of each
   set, finer for larger sets, whose common part bounds the overlap from above. No bound
   skips a pair that links.
2. What is left connects sets to candidate groups, each list passing on only the edges
   that connect its members. Long lists are cut in parts, and each pair of parts is a
   unit of its own, so no task holds a hot list.
3. In each group one set is the pivot. Every other set is sent as its difference from
   the pivot: x and y differ in exactly the grams in which their differences differ,
   |x ^ y| = |(x ^ c) ^ (y ^ c)|. A large group is cut in parts, the pivot goes to each
   of them, and pairs of parts are the units.
4. In a unit, a set's answers are its numbers of common grams with all sets. They start
   from those of the nearest set that has been answered (at first the pivot, whose
   answers are all zero): the index lists of the grams that only the earlier set has are
   taken off, and those that only the new one has are added. Only edges that connect are
   passed on. Their connected components are the classes.

All links between different sets are decided exactly (up to a collision of 64-bit
hashes); pairs inside a class are never written out.

Edge cases: a null or empty text, or one without words, has an empty set and is linked
with nothing. A text with fewer words than n is one gram of all its words. Only id and
text are read. Null ids never are the least id of a class; a class of null ids only has
a null one. Rows that repeat an id are documents of their own. A long text is hashed in
segments. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import keep_rows, lean, mixed, packs, payload, possible, saved, smaller, text_key
from postlens.llm.components import components

SEGMENT = 1 << 20
HOT_GRAMS = 1 << 16
HOT_IN_CHUNK = 3
CHUNK_GRAMS = 1 << 20
LIST_BLOCK = 1024
SKIP_BLOCK = 32
GROUP_BLOCK = 256
GROUP_GRAMS = 1 << 20
SALTS = 256
BINS = (64, 256, 1024, 4096)
FULL_BIN = 65535
KNOWN_SETS = 1 << 18
TEXT_BYTES = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C55)
_BACK = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IS_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


class Words:
    """Hashes of the words of texts: the polynomial of a word's bytes, scrambled."""

    def __init__(self) -> None:
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            step = np.full(n, _BASE)
            step[0] = 1
            self.powers = np.multiply.accumulate(step)
            step = np.full(n, _BACK)
            step[0] = 1
            self.inverse = np.multiply.accumulate(step)

    def of_pack(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all parts, and the number of words of each."""
        data = np.frombuffer(b" ".join([*parts, b""]).translate(_LOWER), np.uint8)
        self._grow(len(data) + 1)
        space = _IS_SPACE[data]
        edge = np.flatnonzero(np.diff(np.r_[True, space]))  # starts and ends in turn
        if not len(edge):
            return np.zeros(0, np.uint64), np.zeros(len(parts), np.int64)
        start, end = edge[::2], edge[1::2]
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=total[1:])
        hashed = mixed((total[end] - total[start]) * self.inverse[start])
        ends = np.cumsum([len(p) + 1 for p in parts])
        below = np.searchsorted(start, ends)
        return hashed, np.diff(np.r_[0, below])

    def of_texts(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The word hashes of each text."""
        parts: list[bytes] = []
        owner: list[int] = []
        for i, text in enumerate(texts):
            at = 0
            while True:
                end = _next_space(text, at + SEGMENT)
                parts.append(text[at:end])
                owner.append(i)
                at = end
                if at >= len(text):
                    break
        waiting: list[np.ndarray] = []
        now = 0
        for a, b in packs([len(p) for p in parts], SEGMENT):
            hashed, count = self.of_pack(parts[a:b])
            cut = np.cumsum(count)
            for i, end, n in zip(owner[a:b], cut.tolist(), count.tolist()):
                if i != now:
                    yield waiting[0] if len(waiting) == 1 else np.concatenate(waiting)
                    waiting, now = [], i
                waiting.append(hashed[end - n : end])
        if waiting:
            yield waiting[0] if len(waiting) == 1 else np.concatenate(waiting)


def _next_space(text: bytes, at: int) -> int:
    """The first place from `at` on where no word is cut."""
    if at >= len(text):
        return len(text)
    found = [p for c in b" \t\n\v\f\r" if (p := text.find(bytes([c]), at)) >= 0]
    return min(found, default=len(text))


def gram_sets(words: Words, texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted set of gram hashes of each text."""
    for w in words.of_texts(texts):
        if not len(w):
            yield w
            continue
        size = min(n, len(w))
        grams = np.full(len(w) - size + 1, size, np.uint64)
        for i in range(size):
            grams = (grams + w[i : len(w) - size + 1 + i]) * _BASE
            grams ^= grams >> np.uint64(29)
        yield np.unique(mixed(grams))


def set_id(grams: np.ndarray) -> int:
    """64 bits that name a set."""
    return int.from_bytes(hashlib.blake2b(grams.tobytes(), digest_size=8).digest(), "little", signed=True)


def histogram(grams: np.ndarray, num: int, den: int) -> bytes:
    """How many grams fall in each bin; larger sets have finer bins, which add up to the coarse ones.

    Two sets of n grams that share none differ by about 1.13 * sqrt(n * bins) over the bins;
    there are as many bins as make that half as much again as sets that link can differ.
    """
    apart = 2 * (den - num) / (den + num)  # of sets that just link, in units of n
    wanted = (1.5 * apart / 1.13) ** 2 * len(grams)
    bins = next((b for b in BINS if b >= wanted), BINS[-1])
    shift = np.uint64(64 - (bins.bit_length() - 1))
    counts = np.bincount((grams >> shift).astype(np.int64), minlength=bins)
    return np.minimum(counts, FULL_BIN).astype("<u2").tobytes()


class Histograms:
    """Those of the rows of some lists, each as fine as its set has it."""

    def __init__(self, raw: list[bytes]):
        self.raw = raw
        self.size = np.array([len(x) // 2 for x in raw])
        self.coarse = np.zeros((len(raw), BINS[0]), np.int64)
        for bins in BINS:
            at = np.flatnonzero(self.size == bins)
            if len(at):
                table = np.frombuffer(b"".join(raw[i] for i in at.tolist()), "<u2").reshape(len(at), BINS[0], -1)
                self.coarse[at] = table.sum(axis=2, dtype=np.int64)

    def common(self, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Bounds from above on the overlaps of pairs (a, b), looked at closely if they reach `least`."""
        out = np.minimum(self.coarse[a], self.coarse[b]).sum(axis=1)
        for k in np.flatnonzero((out >= least) & (np.minimum(self.size[a], self.size[b]) > BINS[0])).tolist():
            x, y = (np.frombuffer(self.raw[i], "<u2").astype(np.int64) for i in (a[k], b[k]))
            bins = min(len(x), len(y))
            x, y = (z.reshape(bins, -1).sum(axis=1) for z in (x, y))
            out[k] = np.minimum(x, y).sum()
        return out


def needed(a, b, num: int, den: int):
    """The least overlap of two sets of these sizes that reaches num / den."""
    return -(-num * (a + b) // (num + den))


def prefix_size(n: int, num: int, den: int) -> int:
    """So many first grams cannot all be missing in a set that links."""
    return n - -(-num * n // den) + 1


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    named = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)], [n for n, _ in named])


def _texts(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for part in smaller(batches, column, TEXT_BYTES):
        yield part, part.column(column).to_pylist()


SETS = "doc_id long, tkey long, n long, sid long, gram long, seen long, bins binary"


def _sets(n: int, num: int, den: int):
    """A row for each document, and the grams that many documents of a chunk share.

    The first document with a set carries the set's histogram.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        known: set[int] = set()
        chunk: list[np.ndarray] = []
        held = 0

        def hot() -> pa.RecordBatch:
            gram, seen = np.unique(np.concatenate(chunk), return_counts=True)
            gram, seen = gram[seen >= HOT_IN_CHUNK], seen[seen >= HOT_IN_CHUNK]
            none = [None] * len(gram)
            return _batch(SETS, none, none, none, none, gram.view(np.int64), seen, none)

        for batch, texts in _texts(batches):
            size: list[int] = []
            sid: list[int] = []
            bins: list[bytes | None] = []
            for grams in gram_sets(words, texts, n):
                size.append(len(grams))
                sid.append(set_id(grams))
                bins.append(None if sid[-1] in known else histogram(grams, num, den))
                known.add(sid[-1])
                chunk.append(grams)
                held += len(grams)
                if held > CHUNK_GRAMS:
                    yield hot()
                    chunk.clear()
                    held = 0
            none = [None] * len(texts)
            yield _batch(SETS, batch.column("doc_id"), batch.column("tkey"), size, sid, none, none, bins)
            if len(known) > KNOWN_SETS:
                known.clear()
        if chunk:
            yield hot()

    return sets


LIST_KEYS = ["gram", "part", "other"]
POSTINGS = "gram long, part int, other int, sid long, n int, pos int"


def _in_order(grams: np.ndarray, count: int, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first `count` grams: plain ones by hash, then hot ones, the rarest first."""
    head = grams[: 2 * count]
    at = np.minimum(np.searchsorted(hot, head), len(hot) - 1) if len(hot) else None
    if at is None:
        return grams[:count]
    plain = head[hot[at] != head]
    if len(plain) >= count or len(head) == len(grams):
        common = at[hot[at] == head]
    else:
        at = np.minimum(np.searchsorted(hot, grams), len(hot) - 1)
        plain, common = grams[hot[at] != grams], at[hot[at] == grams]
    return np.concatenate([plain, hot[common[np.argsort(rank[common], kind="stable")]]])[:count]


def _postings(n: int, num: int, den: int, shared):
    """Each different set's prefix as postings."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, seen = shared.value
        rank = np.argsort(np.argsort(seen, kind="stable"), kind="stable")
        blocks = {int(g): int(-(-s // LIST_BLOCK)) for g, s in zip(hot, seen) if s > LIST_BLOCK}
        words = Words()
        known: set[int] = set()
        for _, texts in _texts(batches):
            rows: list[tuple[np.ndarray, int, int]] = []
            cut: list[tuple[int, int, int, int, int, int]] = []
            for grams in gram_sets(words, texts, n):
                sid = set_id(grams)
                if not len(grams) or sid in known:
                    continue
                known.add(sid)
                first = _in_order(grams, prefix_size(len(grams), num, den), hot, rank)
                rows.append((first, sid, len(grams)))
                if blocks:
                    for pos, gram in enumerate(first.tolist()):
                        for other in range(1, blocks.get(gram, 1)):
                            cut.append((gram, other, blocks[gram], sid, len(grams), pos))
            if not rows:
                continue
            if len(known) > KNOWN_SETS:
                known.clear()
            gram = np.concatenate([r[0] for r in rows])
            size = [len(r[0]) for r in rows]
            sid, count = np.repeat([r[1] for r in rows], size), np.repeat([r[2] for r in rows], size)
            pos = np.concatenate([np.arange(s) for s in size])
            part = np.zeros(len(gram), np.int32)
            other = np.zeros(len(gram), np.int32)
            if blocks:  # a set of block b goes to all pairs (b, k); the first of them is written in place
                total = np.array([blocks.get(g, 1) for g in gram.tolist()])
                other = (sid % total).astype(np.int32)
                if cut:
                    g, k, all_, s, c, p = (np.array(x, np.uint64 if i == 0 else np.int64) for i, x in enumerate(zip(*cut)))
                    mine = s % all_
                    gram = np.concatenate([gram, g])
                    part = np.concatenate([part, np.minimum(mine, k)]).astype(np.int32)
                    other = np.concatenate([other, np.maximum(mine, k)]).astype(np.int32)
                    sid, count, pos = np.concatenate([sid, s]), np.concatenate([count, c]), np.concatenate([pos, p])
            yield _batch(POSTINGS, gram.view(np.int64), part, other, sid, count.astype(np.int32), pos.astype(np.int32))

    return postings


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Neighbouring rows with equal keys."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = [*_starts(batch, keys).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(batch.column(k)[a].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _partnered(num: int, den: int):
    """Keeps the rows of a list that have a partner of a size that can link; one row for each set.

    Input is sorted by list, size and set, so that the sizes next to a row's own decide.
    """

    def fit(rows: pa.RecordBatch) -> pa.RecordBatch:
        start = _starts(rows, LIST_KEYS)
        sid, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("sid", "n"))
        first = np.zeros(len(sid), bool)
        first[start] = True
        new = first | np.r_[True, sid[1:] != sid[:-1]]
        rows, first, n = rows.filter(pa.array(new)), first[new], n[new]
        after = np.r_[~first[1:] & (den * n[:-1] >= num * n[1:]), False]
        return rows.filter(pa.array(after | np.r_[False, after[:-1]]))

    def partnered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last list, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            joined = batch if held is None else _joined([held, batch])
            last = int(_starts(joined, LIST_KEYS)[-1])
            if last:
                yield fit(joined.slice(0, last))
            held = joined.slice(last)
        if held is not None:
            yield fit(held)

    return partnered


EDGES = "a long, b long"


def _spread(links) -> list[tuple[int, int]]:
    """Edges that connect what links connect.

    `links.first()` takes a row that no edge has reached (-1: there is none), and
    `links.reached(i)` takes those of them that link with i.
    """
    edges: list[tuple[int, int]] = []
    while (seed := links.first()) >= 0:
        queue = [seed]
        while queue:
            i = queue.pop()
            found = links.reached(i).tolist()
            edges += [(i, j) for j in found]
            queue += found
    return edges


def _may_link(n, pos, bins, i, j, num: int, den: int) -> np.ndarray:
    """Which pairs (i, j) of one index list size, position and histogram do not rule out."""
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    least = needed(n[i], n[j], num, den)
    hit = den * small >= num * large
    hit &= np.minimum(n[i] - pos[i], n[j] - pos[j]) >= least
    near = np.flatnonzero(hit)
    a, b = (np.broadcast_to(x, hit.shape)[near] for x in (i, j))
    hit[near] = (bins.common(a, b, least[near]) >= least[near]) | (small[near] > FULL_BIN)  # a full bin says nothing
    return hit


class _ListLinks:
    """The pairs of one index list, `rows` of all, that may link, by blocks of the list.

    Each block has the sizes in it and the most grams that any entry has left after its position.
    """

    def __init__(self, rows, n, pos, bins: Histograms, num: int, den: int):
        self.n, self.pos, self.bins, self.num, self.den = n, pos, bins, num, den
        # Sizes in a band can all link with each other, so within one the position decides.
        band = np.floor(np.log(n[rows]) / max(np.log(den / num), 1e-3))
        rows = rows[np.lexsort((pos[rows], band))]
        start = np.arange(0, len(rows), SKIP_BLOCK)
        self.low, self.high = np.minimum.reduceat(n[rows], start), np.maximum.reduceat(n[rows], start)
        self.left = np.maximum.reduceat((n - pos)[rows], start)
        shape = (len(start), min(SKIP_BLOCK, len(rows)))
        self.table = np.resize(rows, shape)
        self.open = np.arange(self.table.size).reshape(shape) < len(rows)  # entries that no edge has reached

    def first(self) -> int:
        at = np.unravel_index(self.open.argmax(), self.open.shape)
        if not self.open[at]:
            return -1
        self.open[at] = False
        return int(self.table[at])

    def blocks(self, i: int) -> np.ndarray:
        """The blocks that may hold a partner of entry i."""
        n, left = self.n[i], self.n[i] - self.pos[i]
        fits = (self.den * self.high >= self.num * n) & (self.den * n >= self.num * self.low)
        return np.flatnonzero(fits & (np.minimum(self.left, left) >= needed(n, self.low, self.num, self.den)))

    def reached(self, i: int) -> np.ndarray:
        blocks = self.blocks(i)
        block, column = np.nonzero(self.open[blocks])
        block = blocks[block]
        rest = self.table[block, column]
        hit = _may_link(self.n, self.pos, self.bins, rest, np.int64(i), self.num, self.den)
        self.open[block[hit], column[hit]] = False
        return rest[hit]


def _list_edges(num: int, den: int):
    """Edges that connect what may link in each list; input is sorted by list."""

    def of_lists(rows: pa.RecordBatch, start: np.ndarray) -> pa.RecordBatch:
        sid, n, pos = (rows.column(c).to_numpy().astype(np.int64) for c in ("sid", "n", "pos"))
        bins = Histograms(rows.column("bins").to_pylist())
        size = np.diff(np.r_[start, len(sid)])
        pairs = start[size == 2]  # most lists: all of them at once
        pairs = pairs[_may_link(n, pos, bins, pairs, pairs + 1, num, den)]
        a, b = [sid[pairs]], [sid[pairs + 1]]
        for first, count in zip(start[size > 2].tolist(), size[size > 2].tolist()):
            found = _spread(_ListLinks(np.arange(first, first + count), n, pos, bins, num, den))
            if found:
                i, j = np.array(found).T
                a.append(sid[i])
                b.append(sid[j])
        return _batch(EDGES, np.concatenate(a), np.concatenate(b))

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of a list that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            start = _starts(batch, LIST_KEYS)
            goes_on = bool(held) and _key(held[-1], held[-1].num_rows - 1) == _key(batch, 0)
            if goes_on and len(start) == 1:
                held.append(batch)
                continue
            if goes_on:
                held.append(batch.slice(0, start[1]))
                batch, start = batch.slice(start[1]), start[1:] - start[1]
            if held:
                yield of_lists(_joined(held), np.zeros(1, np.int64))
            held = [batch.slice(start[-1])]
            if len(start) > 1:
                yield of_lists(batch.slice(0, start[-1]), start[:-1])
        if held:
            yield of_lists(_joined(held), np.zeros(1, np.int64))

    return edges


def _key(batch: pa.RecordBatch, at: int) -> tuple:
    return tuple(batch.column(k)[at].as_py() for k in LIST_KEYS)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where runs of equal keys begin."""
    change = np.zeros(batch.num_rows - 1, bool)
    for k in keys:
        c = batch.column(k).to_numpy(zero_copy_only=False)
        change |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[True, change])


MEMBERS = "root long, sid long, n int, grams binary"


def _members(n: int):
    """The sets of the rows whose set is the expected one."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch, texts in _texts(batches):
            roots, expected = batch.column("root").to_pylist(), batch.column("sid").to_pylist()
            out = [
                (root, sid, len(grams), grams.tobytes())
                for root, sid, grams in zip(roots, expected, gram_sets(words, texts, n))
                if set_id(grams) == sid
            ]
            for at in range(0, len(out), 200):
                yield _batch(MEMBERS, *zip(*out[at : at + 200]))

    return members


DIFFERENCES = "root long, sid long, n int, diff binary"


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, pivot = batch.column("grams").to_pylist(), batch.column("pivot").to_pylist()
        out = [np.setxor1d(np.frombuffer(x, np.uint64), np.frombuffer(c, np.uint64), True).tobytes() for x, c in zip(own, pivot)]
        yield _batch(DIFFERENCES, batch.column("root"), batch.column("sid"), batch.column("n"), out)


class _GroupLinks:
    """Pairs that reach the threshold, a set's answers derived from those of the nearest set answered before it.

    The answers of a unit's sets are kept until its end: a square of numbers, of about twice
    GROUP_BLOCK rows.
    """

    def __init__(self, n: np.ndarray, diffs: list[np.ndarray], num: int, den: int):
        self.n, self.num, self.den = n, num, den
        self.size = np.array([len(d) for d in diffs], np.int64)
        owner = np.repeat(np.arange(len(diffs)), self.size)
        gram, code, seen = np.unique(np.concatenate(diffs), return_inverse=True, return_counts=True)
        shared = seen[code] > 1  # a gram of one difference is in no intersection
        owner, code = owner[shared], code[shared]
        self.by_set = np.split(code, np.searchsorted(owner, np.arange(1, len(diffs))))
        order = np.argsort(code, kind="stable")
        self.owners = owner[order]
        self.list_at = np.searchsorted(code[order], np.arange(len(gram) + 1))
        self.open = np.ones(len(diffs), bool)  # sets that no edge has reached
        self.answers: dict[int, np.ndarray] = {}
        self.shared = np.array([len(c) for c in self.by_set], np.int64)
        self.nearest = np.full(len(diffs), -1)  # the pivot
        self.apart = self.shared.copy()  # from the nearest, in grams that have lists

    def first(self) -> int:
        """The set with the least to correct."""
        left = np.flatnonzero(self.open)
        if not len(left):
            return -1
        i = int(left[self.apart[left].argmin()])
        self.open[i] = False
        return i

    def _counted(self, codes: np.ndarray) -> np.ndarray:
        """How many of these grams each set has."""
        lists = [self.owners[self.list_at[c] : self.list_at[c + 1]] for c in codes.tolist()]
        return np.bincount(np.concatenate(lists), minlength=len(self.n)) if lists else np.zeros(len(self.n), np.int64)

    def answered(self, i: int) -> np.ndarray:
        """The grams that set i has in common with each set."""
        base = int(self.nearest[i])
        if base < 0:
            common = self._counted(self.by_set[i])
        else:
            new = np.setdiff1d(self.by_set[i], self.by_set[base], assume_unique=True)
            gone = np.setdiff1d(self.by_set[base], self.by_set[i], assume_unique=True)
            common = self.answers[base] + self._counted(new) - self._counted(gone)
        self.answers[i] = common.astype(np.int32)
        apart = self.shared + self.shared[i] - 2 * common
        nearer = apart < self.apart
        self.nearest[nearer], self.apart[nearer] = i, apart[nearer]
        return common

    def reached(self, i: int) -> np.ndarray:
        rest = np.flatnonzero(self.open)
        if not len(rest):
            return rest
        apart = self.size[rest] + self.size[i] - 2 * self.answered(i)[rest]
        both = self.n[rest] + self.n[i]
        found = rest[(both - apart) // 2 >= needed(self.n[rest], self.n[i], self.num, self.den)]
        self.open[found] = False
        return found


def _group_edges(num: int, den: int):
    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, ["root", "part", "other"]):
            sid = run.column("sid").to_numpy()
            diffs = [np.frombuffer(x, np.uint64) for x in run.column("diff").to_pylist()]
            found = _spread(_GroupLinks(run.column("n").to_numpy().astype(np.int64), diffs, num, den))
            if found:
                i, j = (np.array(x) for x in zip(*found))
                yield _batch(EDGES, sid[i], sid[j])

    return edges


def _candidates(postings: DataFrame, bins: DataFrame, num: int, den: int) -> DataFrame:
    """(node, root): sets that may link, by group."""
    keys = LIST_KEYS
    lists = postings.repartition(*keys).sortWithinPartitions(*keys, "n", "sid")
    lists = saved(lists.mapInArrow(lean(_partnered(num, den)), lists.schema), "lists")
    units = lists.join(bins, "sid").repartition(*keys).sortWithinPartitions(*keys)
    return saved(components(units.mapInArrow(lean(_list_edges(num, den)), EDGES)), "candidates")


def _in_parts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows with the number of parts of their group, and which of them is their own.

    Groups of one part need no look-up. The rows of a larger one, of over GROUP_BLOCK rows or
    so, meet its number at SALTS places, so that no task holds a hot group.
    """
    large = sizes.filter("parts > 1").select("root", "parts", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("sid", F.lit("salt")), F.lit(SALTS)).cast("int"))
    parts = F.coalesce("parts", F.lit(1))
    mine = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    return salted.join(large, ["root", "salt"], "left").drop("salt").withColumn("parts", parts).withColumn("mine", mine)


def _links(docs: DataFrame, sets: DataFrame, groups: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Edges between sets that connect exactly the sets that links connect."""
    first = sets.groupBy("sid").agg(F.min(F.struct("key", "tkey")).alias("first"))
    wanted = groups.join(first, groups["node"] == first["sid"]).select("root", "sid", "first.key", "first.tkey")
    wanted = saved(wanted, "wanted")
    texts = possible(docs.select("key", "tkey", "text"), wanted, "tkey").join(wanted, ["key", "tkey"])
    texts = texts.select("root", "sid", "text")
    members = saved(texts.mapInArrow(lean(_members(n)), MEMBERS), "members", batch_rows=1000)
    sizes = members.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCK).cast("int").alias("parts"))
    pivots = members.filter("root = sid").groupBy("root").agg(F.min("grams").alias("pivot")).join(sizes, "root")
    pivots = pivots.select("root", "pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("mine"))
    diffs = _in_parts(members, sizes).join(pivots, ["root", "mine"]).mapInArrow(lean(_differences), DIFFERENCES)
    diffs = saved(diffs, "differences", batch_rows=500)
    sizes = diffs.groupBy("root").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("diff")).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("rows") / GROUP_BLOCK), F.ceil(F.col("bytes") / (8 * GROUP_GRAMS)))
    units = _in_parts(diffs, sizes.select("root", parts.cast("int").alias("parts"))).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("k")
    )
    units = units.select(
        "root", "sid", "n", "diff", F.least("mine", "k").alias("part"), F.greatest("mine", "k").alias("other")
    )
    keys = ["root", "part", "other"]
    return units.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lean(_group_edges(num, den)), EDGES)


def classified(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, tkey, n, label, first) of every row; `first` is its class's least (no_id, doc_id, tkey)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-1)).alias("key"),
        text_key(text_col).alias("tkey"),
        payload(text_col).alias("text"),
    )
    found = saved(rows.select("doc_id", "tkey", "text").mapInArrow(lean(_sets(n, num, den)), SETS), "sets")
    top = found.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum("seen").alias("seen"))
    top = top.orderBy(F.desc("seen"), "gram").limit(HOT_GRAMS).toArrow()
    hot = top.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(hot)
    shared = spark.sparkContext.broadcast((hot[order], top.column("seen").to_numpy()[order]))
    postings = rows.select("text").mapInArrow(lean(_postings(n, num, den, shared)), POSTINGS)
    bins = found.filter("bins IS NOT NULL").groupBy("sid").agg(F.min("bins").alias("bins"))
    sets = found.filter("n IS NOT NULL").select("doc_id", F.coalesce("doc_id", F.lit(-1)).alias("key"), "tkey", "n", "sid")
    groups = _candidates(postings, bins, num, den)
    classes = saved(components(_links(rows, sets.filter("n > 0"), groups, n, num, den)), "classes")
    labelled = sets.join(classes, sets["sid"] == classes["node"], "left").select(
        "doc_id", "tkey", "n", F.coalesce("root", F.col("sid")).alias("label")
    )
    labelled = saved(labelled, "labels")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("tkey"))
    full = labelled.filter("n > 0")
    firsts = saved(full.groupBy("label").agg(F.min(place).alias("first")), "firsts")
    linked = full.join(firsts, "label")
    return linked.unionByName(labelled.filter("n = 0").withColumn("first", place))


def link_classes(
    docs: DataFrame, n: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row: documents link at a Jaccard similarity of num / den.

    `n` is the number of words of a gram.
    """
    found = classified(docs, n, num, den, id_col, text_col)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))


def one_per_class(
    docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that stay, with all columns, if one document, of the least id, stays of each class."""
    found = classified(docs, n, num, den, id_col, text_col)
    mine = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("tkey") == F.col("first.tkey"))
    return keep_rows(docs, found.filter(mine & (F.col("n") > 0) | (F.col("n") == 0)), id_col, text_col, repeats=F.col("n") == 0)
