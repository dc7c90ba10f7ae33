"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes if a string of `min_len` bytes that covers it also starts earlier: in a row
of a smaller id, or further left in the same text. The first copy stays.

The suffix order of a whole corpus is cut into independent parts, so that two suffixes
that share their first `min_len` bytes are sorted in the same place:

1. Each window of `min_len` bytes is represented by its least gram of `GRAM` bytes, by
   hash and then leftmost: its anchor. Equal windows have equal anchors at equal places.
   Windows with one anchor are neighbours, so an anchor stands for a run of windows.
2. Anchors that occur once cannot start a match and fall away. Each task sends one
   occurrence of a gram; further ones in the same task are known to be repeated.
3. For the others, the run's bytes are sent to the part of its gram. Runs of equal bytes
   keep the earliest; the later ones are covered. Where a gram has different runs left,
   their suffixes are sorted. In suffix order, neighbours that share `min_len` bytes
   form a stretch, and a suffix has an earlier factor of that length exactly if its
   previous or next smaller position lies in its stretch: its window is removed.
   Runs of a hot gram, one with many windows, are cut into single windows first, each
   named by a hash of all its bytes: equal windows still meet, but the gram is spread.
   Tasks send the earliest of equal windows only, found in the same way.
4. Each text loses the union of its windows.

Equal texts are found first by SHA-256: the first is kept as one, and the others are
covered whole. Packets of hashes and texts are compressed for the shuffles.

Edge cases: a null text is empty. A text of fewer bytes than `min_len` stays whole. A
null id comes after all others; equal ids are ordered by a hash of the text, and of
rows that repeat id and text one is the first. Only id and text are read. Texts are
scanned one after the other in segments, and may hold any bytes. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import mixed, payload, possible, saved, smaller, text_key

MIN_LEN = 100
GRAM = 24
SEGMENT = 1 << 14
SLICE_BYTES = 1 << 22
CHUNK_ANCHORS = 1 << 19
CHUNK_RUNS = 1 << 16
CHUNK_WINDOWS = 1 << 17
HOT_WINDOWS = 1 << 17
LAST = (1 << 63) - 1
_BASE = np.uint64(0x9E3779B97F4A7C55)
_SPREAD = np.uint64(0x94D049BB133111EB)
_LOW = np.uint64(0xFFFFFFFF)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the `size` bytes from each place on, taken in words of eight bytes; the last word may overlap the one before."""
    n = max(0, len(data) - size + 1)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)).astype(np.uint64)
    if size < 8:
        return mixed((words[:n] & np.uint64((1 << 8 * size) - 1)) + _BASE)
    done = words[:n] * _BASE
    for at in [*range(8, size - 8, 8), *[size - 8][: size - 8]]:
        done ^= done >> np.uint64(32)
        done += words[at : at + n]
        done *= _BASE
    done ^= done >> np.uint64(29)
    done *= _SPREAD
    done ^= done >> np.uint64(32)
    return done


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    span = 1
    while 2 * span <= width:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _bytes(column: pa.Array) -> tuple[np.ndarray, ...]:
    """(all bytes, start, size) of strings without nulls."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    start, data = offsets - offsets[0], column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return flat, start[:-1], np.diff(start)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """`count` numbers from each `first` on."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def runs(data: np.ndarray, start: np.ndarray, size: np.ndarray, min_len: int) -> tuple[np.ndarray, ...]:
    """(text, hash, anchor, first window, last window) for each run of windows with one anchor, in the texts that follow one another in `data`."""
    gram = min(GRAM, max(1, min_len // 4))
    found = []
    for at in range(0, max(0, len(data) - min_len + 1), SEGMENT):
        hashed = gram_hashes(data[at : at + SEGMENT + min_len - 1], gram)
        keyed = (hashed & ~_LOW) | np.arange(len(hashed), dtype=np.uint64)
        place = (least_in_windows(keyed, min_len - gram + 1) & _LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        anchor = place[first]
        found.append((hashed[anchor], anchor + at, first + at))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    hashed, anchor, first = (np.concatenate(x) for x in zip(*found))
    # A run may go on in the next segment.
    whole = np.r_[True, anchor[1:] != anchor[:-1]]
    hashed, anchor, first = hashed[whole], anchor[whole], first[whole]
    # Windows over the end of a text are none of its own.
    text = np.flatnonzero(size >= min_len)
    low, high = start[text], start[text] + size[text] - min_len
    from_, to = np.searchsorted(first, low, "right") - 1, np.searchsorted(first, high, "right")
    here, text = _ranges(from_, to - from_), np.repeat(text, to - from_)
    last = np.minimum(np.r_[first[1:] - 1, len(data)][here], np.repeat(high, to - from_))
    first = np.maximum(first[here], start[text])
    return text, hashed[here], anchor[here] - start[text], first - start[text], last - start[text]


def earlier_factor(suffixes: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether an equal string of a smaller position is among `suffixes`.

    In suffix order, equal ones form stretches. A suffix has an earlier factor if the
    least position before it in its stretch (its previous smaller one) or after it (its
    next smaller one) is below its own.
    """
    n = len(suffixes)
    if not n:
        return np.zeros(0, bool)
    order = np.argsort(suffixes, kind="stable")
    sorted_, own = suffixes[order], position[order].astype(np.int64)
    stretch = np.cumsum(np.r_[0, (sorted_[1:] != sorted_[:-1]).astype(np.int64)])
    span = int(own.max()) + 2
    # Stretches take turns in value, so that a running least never reaches over a border.
    down = own + (stretch[-1] - stretch) * span
    before = np.minimum.accumulate(down)
    previous = np.r_[False, (before[:-1] < down[1:]) & (stretch[1:] == stretch[:-1])]
    up = own + stretch * span
    after = np.minimum.accumulate(up[::-1])[::-1]
    following = np.r_[(after[1:] < up[:-1]) & (stretch[1:] == stretch[:-1]), False]
    out = np.zeros(n, bool)
    out[order] = previous | following
    return out


def _merged(key: np.ndarray, tkey: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The spans of each text in order, those that touch in one."""
    order = np.lexsort((start, tkey, key))
    key, tkey, start, end = key[order], tkey[order], start[order], end[order]
    if not len(order):
        return key, tkey, start, end
    other = np.r_[True, (key[1:] != key[:-1]) | (tkey[1:] != tkey[:-1])]
    # Texts take turns in value, so that a running end never reaches over a border.
    turn = np.cumsum(other) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + turn) - turn
    first = np.flatnonzero(other | np.r_[True, start[1:] > reach[:-1]])
    return key[first], tkey[first], start[first], reach[np.r_[first[1:], len(order)] - 1]


def _earliest(data: pa.Array, key: np.ndarray, tkey: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the earliest of equal strings are, and where those at other places are."""
    code = data.dictionary_encode().indices.to_numpy()
    order = np.lexsort((first, tkey, key, code))
    leads = np.r_[True, code[order][1:] != code[order][:-1]][: len(order)]
    own = order[leads][np.cumsum(leads) - 1]
    other = (key[order] != key[own]) | (tkey[order] != tkey[own]) | (first[order] != first[own])
    return order[leads], order[other]


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    named = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)], [n for n, _ in named])


ANCHORS = "bucket int, hashes binary, tkeys binary, places binary, repeated binary"


def _anchors(min_len: int, buckets: int):
    """Packets of anchors for each bucket of hashes.

    `hashes`, `tkeys` and `places` list grams that this chunk has once; `repeated` lists
    hashes that it has more than once. Those occurrences come with no hash.
    """

    def chunk_rows(hashed: np.ndarray, tkeys: np.ndarray, places: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(hashed, kind="stable")
        hashed, tkeys, places = hashed[order], tkeys[order], places[order]
        first = np.flatnonzero(np.r_[True, hashed[1:] != hashed[:-1]])
        size = np.diff(np.r_[first, len(hashed)])
        many = np.repeat(size > 1, size)
        low = (hashed & _LOW).astype(np.uint32)
        # The hash's upper half deals out, its lower half is sent.
        single = by_bucket((hashed >> np.uint64(32)) % np.uint64(buckets), ~many)
        several = by_bucket((hashed >> np.uint64(32)) % np.uint64(buckets), many & np.r_[True, hashed[1:] != hashed[:-1]])
        certain = by_bucket(tkeys.view(np.uint64) % np.uint64(buckets), many)
        for b in range(buckets):
            one, more, here = single[b], several[b], certain[b]
            if len(one) or len(more):
                yield b, low[one].tobytes(), tkeys[one].tobytes(), places[one].astype(np.uint32).tobytes(), low[more].tobytes()
            if len(here):
                yield b, None, tkeys[here].tobytes(), places[here].astype(np.uint32).tobytes(), None

    def by_bucket(bucket: np.ndarray, which: np.ndarray) -> list[np.ndarray]:
        at = np.flatnonzero(which)
        at = at[np.argsort(bucket[at], kind="stable")]
        return np.split(at, np.searchsorted(bucket[at], np.arange(1, buckets, dtype=np.uint64)))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0
        known: set[int] = set()

        def flush() -> pa.RecordBatch:
            rows = list(chunk_rows(*[np.concatenate(x) for x in zip(*chunk)]))
            return _batch(ANCHORS, *zip(*rows))

        for batch in smaller(batches, "text", SLICE_BYTES):
            # Adds a key and tells whether it is new.
            new = [t not in known and not known.add(t) for t in batch.column("tkey").to_pylist()]
            batch = batch.filter(pa.array(new, pa.bool_()))
            text, hashed, anchor, *_ = runs(*_bytes(batch.column("text")), min_len)
            if not len(hashed):
                continue
            chunk.append((hashed, batch.column("tkey").to_numpy()[text], anchor))
            held += len(hashed)
            if held > CHUNK_ANCHORS:
                yield flush()
                chunk.clear()
                known.clear()
                held = 0
        if chunk:
            yield flush()

    return anchors


PLACES = "tkey long, places binary"


def _by_text(tkeys: np.ndarray, places: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(tkeys):
        order = np.argsort(tkeys, kind="stable")
        tkeys, places = tkeys[order], places[order]
        first = np.flatnonzero(np.r_[True, tkeys[1:] != tkeys[:-1]])
        yield _batch(PLACES, tkeys[first], [x.astype(np.uint32).tobytes() for x in np.split(places, first[1:])])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the anchors that occur more than once; input is sorted by bucket."""
    held: list[list] = [[], [], [], []]
    now = None

    def flush() -> Iterator[pa.RecordBatch]:
        if not held[0]:
            return
        hashes = np.frombuffer(b"".join(held[0]), np.uint32)
        tkeys = np.frombuffer(b"".join(held[1]), np.int64)
        places = np.frombuffer(b"".join(held[2]), np.uint32)
        known = np.unique(np.frombuffer(b"".join(held[3]), np.uint32))
        order = np.lexsort((places, tkeys, hashes))
        hashes, tkeys, places = hashes[order], tkeys[order], places[order]
        new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
        # The same place of an equal text in another task is no second occurrence.
        other = np.r_[False, (tkeys[1:] != tkeys[:-1]) | (places[1:] != places[:-1])][: len(hashes)] & ~new
        group = np.cumsum(new) - 1
        several = np.bincount(group, other, minlength=len(hashes)) > 0 if len(hashes) else np.zeros(0, bool)
        keep = several[group] | np.isin(hashes, known)
        yield from _by_text(tkeys[keep], places[keep])

    for batch in batches:
        for bucket, *columns in zip(*[c.to_pylist() for c in batch.columns]):
            if columns[0] is None:
                yield from _by_text(np.frombuffer(columns[1], np.int64), np.frombuffer(columns[2], np.uint32))
                continue
            if bucket != now:
                yield from flush()
                now = bucket
                held = [[], [], [], []]
            for some, x in zip(held, columns):
                some.append(x)
    yield from flush()


PACKED_TEXT = "key long, tkey long, packed binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3, write_content_size=True)
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            packed = [pack.compress(t.as_py()) for t in part.column("text")]
            yield _batch(PACKED_TEXT, part.column("key"), part.column("tkey"), packed)


def _unpacked(column: pa.Array) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor()
    for x in column:
        yield unpack.decompress(x.as_py())


RUNS = "gram long, key long, tkey long, first long, size long, bytes binary"


def _covered_rows(key: np.ndarray, tkey: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spans as rows of runs without gram and bytes."""
    if len(key):
        yield _batch(RUNS, pa.nulls(len(key), pa.int64()), key, tkey, start, end - start, pa.nulls(len(key), pa.binary()))


def _texts_and_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(key, tkey, lists of places, text) of about `SLICE_BYTES` bytes of texts at a time."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "tkey", "places")]
        for row in zip(*columns, _unpacked(batch.column("packed"))):
            held.append(row)
            size += len(row[3])
            if size > SLICE_BYTES:
                yield tuple(zip(*held))
                held, size = [], 0
    if held:
        yield tuple(zip(*held))


def _runs_of_repeats(min_len: int):
    """The bytes under each run of a repeated anchor.

    Of equal runs in a chunk only the earliest is sent as bytes; the others (gram and
    bytes null) are covered, those that touch as one.
    """

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk: list[tuple] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            gram, key, tkey, first = (np.concatenate(x) for x in list(zip(*chunk))[:4])
            data = pa.concat_arrays([x[4] for x in chunk])
            size = pc.binary_length(data).to_numpy().astype(np.int64)
            sent, later = _earliest(data, key, tkey, first)
            yield _batch(RUNS, gram[sent], key[sent], tkey[sent], first[sent], size[sent], data.take(pa.array(sent)))
            yield from _covered_rows(*_merged(key[later], tkey[later], first[later], (first + size)[later]))

        for keys, tkeys, lists, texts in _texts_and_lists(batches):
            places = [b"".join(some) for some in lists]
            count = np.array([len(some) // 4 for some in places])
            wanted = np.sort(np.repeat(np.arange(len(texts)), count) << 32 | np.frombuffer(b"".join(places), np.uint32))
            size = np.array([len(t) for t in texts])
            start = np.cumsum(size) - size
            flat = b"".join(texts)
            text, hashed, anchor, first, last = runs(np.frombuffer(flat, np.uint8), start, size, min_len)
            place = text << 32 | anchor
            here = np.searchsorted(wanted, place, "right") > np.searchsorted(wanted, place)
            text, hashed, first, last = text[here], hashed[here], first[here], last[here]
            if not len(text):
                continue
            at, to = (first + start[text]).tolist(), (last + start[text] + min_len).tolist()
            data = pa.array([flat[a:b] for a, b in zip(at, to)], pa.binary())
            chunk.append((hashed.view(np.int64), np.array(keys, np.int64)[text], np.array(tkeys, np.int64)[text], first, data))
            held += len(text)
            if held > CHUNK_RUNS:
                yield from flush()
                chunk.clear()
                held = 0
        if chunk:
            yield from flush()

    return repeats


SPANS = "key long, tkey long, start long, end long"


def _shared(values: np.ndarray) -> np.ndarray:
    """Whether a value is there more than once."""
    order = np.argsort(values)
    same = values[order][1:] == values[order][:-1]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def _suffixes(key: np.ndarray, tkey: np.ndarray, first: np.ndarray, data: pa.Array, min_len: int) -> tuple[np.ndarray, ...]:
    """(key, tkey, start, hash, bytes, whether it has an earlier factor) for each window of runs in order of their places.

    Windows whose hash no other one has are equal to none: only the others are sorted.
    """
    order = np.lexsort((first, tkey, key))
    flat, at, size = _bytes(data)
    n = (size - min_len + 1)[order]
    owner = np.repeat(order, n)
    within = _ranges(np.zeros(len(n), np.int64), n)
    at = at[owner] + within
    hashed = gram_hashes(flat, min_len)[at]
    key, tkey, start = key[owner], tkey[owner], first[owner] + within
    again = np.flatnonzero(_shared(hashed))
    windows = np.lib.stride_tricks.sliding_window_view(flat, min_len)
    sorted_ = np.ascontiguousarray(windows[at[again]]).view(f"S{min_len}").ravel()
    order = np.lexsort((start, tkey, key))
    # The same place of a row that repeats id and text has the same position.
    new = np.zeros(len(order), np.int64)
    for column in (key, tkey, start):
        new[1:] |= column[order][1:] != column[order][:-1]
    position = np.empty(len(order), np.int64)
    position[order] = np.cumsum(new)
    hit = np.zeros(len(at), bool)
    hit[again] = earlier_factor(sorted_, position[again])
    return key, tkey, start, hashed, at, hit


def _stretches(key: np.ndarray, tkey: np.ndarray, start: np.ndarray, hit: np.ndarray, min_len: int) -> tuple[np.ndarray, ...]:
    """(key, tkey, start, end) of the windows hit, neighbours in one."""
    next_ = np.r_[False, (key[1:] == key[:-1]) & (tkey[1:] == tkey[:-1]) & (start[1:] == start[:-1] + 1)]
    first = np.flatnonzero(hit & ~(np.r_[False, hit[:-1]] & next_))
    last = np.flatnonzero(hit & ~np.r_[hit[1:] & next_[1:], False])
    return key[first], tkey[first], start[first], start[last] + min_len


def _held(batches: list[pa.RecordBatch]) -> tuple:
    """(gram, key, tkey, first, bytes) of runs."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    [data] = rows.column("bytes").chunks or [pa.array([], pa.binary())]
    return *[rows.column(c).to_numpy() for c in ("gram", "key", "tkey", "first")], data


def _single_windows(min_len: int):
    """Runs as single windows, each with the hash of its bytes as its gram.

    Of equal windows in a chunk only the earliest is sent as bytes; the others (gram
    and bytes null) are covered.
    """

    def cut(_, keys: np.ndarray, tkeys: np.ndarray, firsts: np.ndarray, data: pa.Array) -> Iterator[pa.RecordBatch]:
        key, tkey, start, hashed, at, hit = _suffixes(keys, tkeys, firsts, data, min_len)
        yield from _covered_rows(*_stretches(key, tkey, start, hit, min_len))
        flat = _bytes(data)[0].tobytes()
        left = np.flatnonzero(~hit)
        for some in np.split(left, range(10000, len(left), 10000)):
            single = [flat[a : a + min_len] for a in at[some].tolist()]
            yield _batch(RUNS, hashed.view(np.int64)[some], key[some], tkey[some], start[some], np.full(len(some), min_len), single)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = np.cumsum(batch.column("size").to_numpy() - min_len + 1)
            cuts = np.searchsorted(windows, np.arange(CHUNK_WINDOWS, windows[-1] if len(windows) else 0, CHUNK_WINDOWS))
            for a, b in zip([0, *cuts], [*cuts, len(windows)]):
                if b > a:
                    yield from cut(*_held([batch.slice(a, b - a)]))

    return single


def dealt_runs(found: DataFrame, min_len: int) -> DataFrame:
    """The runs found, those of hot grams as single windows: no gram is left with more windows than one task takes,
    other than equal ones of different chunks."""
    sent = found.filter("gram IS NOT NULL")
    n = F.col("size") - (min_len - 1)
    hot = saved(sent.groupBy("gram").agg(F.sum(n).alias("n")).filter(F.col("n") > HOT_WINDOWS).select("gram"), "hot")
    if hot.isEmpty():
        return found
    cut = saved(sent.join(hot, "gram", "left_semi").select(*found.columns).mapInArrow(_single_windows(min_len), RUNS), "windows")
    rest = sent.join(hot, "gram", "left_anti").select(*found.columns)
    return rest.unionByName(found.filter("gram IS NULL")).unionByName(cut)


def _matches(min_len: int):
    """Removed spans of the runs of each gram; input is sorted by gram."""

    def matched(gram: np.ndarray, key: np.ndarray, tkey: np.ndarray, first: np.ndarray, data: pa.Array) -> Iterator[pa.RecordBatch]:
        """Of runs of whole grams."""
        size = pc.binary_length(data).to_numpy().astype(np.int64)
        group = np.cumsum(np.r_[False, gram[1:] != gram[:-1]])
        longer, single = np.flatnonzero(size > min_len), np.flatnonzero(size == min_len)
        kept, later = (longer[x] for x in _earliest(data.take(pa.array(longer)), key[longer], tkey[longer], first[longer]))
        spans = [(key[later], tkey[later], first[later], (first + size)[later])]
        left = np.r_[kept, single]
        several = left[np.bincount(group[left], minlength=group[-1] + 1)[group[left]] > 1]
        if len(several):
            key, tkey, start, _, _, hit = _suffixes(key[several], tkey[several], first[several], data.take(pa.array(several)), min_len)
            spans.append(_stretches(key, tkey, start, hit, min_len))
        columns = _merged(*[np.concatenate(x) for x in zip(*spans)])
        if len(columns[0]):
            yield _batch(SPANS, *columns)

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if held[0].column("gram")[0] == batch.column("gram")[-1]:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            gram = rows.column("gram").to_numpy()
            windows = np.cumsum(rows.column("size").to_numpy() - min_len + 1)
            # Cut between grams, after `CHUNK_WINDOWS` windows or more; the last gram may go on.
            border = np.flatnonzero(gram[1:] != gram[:-1]) + 1
            at = 0
            while at < border[-1]:
                reached = windows[at - 1] if at else 0
                to = border[min(np.searchsorted(windows[border - 1], reached + CHUNK_WINDOWS), len(border) - 1)]
                yield from matched(*_held([rows.slice(at, to - at)]))
                at = to
            held = [rows.slice(at)]
        if held:
            yield from matched(*_held(held))

    return matches


KEPT = "key long, tkey long, n_removed long, n_spans long, kept binary"


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        owner, flat = np.repeat(np.arange(len(spans)), pc.list_value_length(spans).to_numpy()), spans.flatten()
        start, end = (pc.struct_field(flat, name).to_numpy() for name in ("start", "end"))
        owner, _, start, end = _merged(owner, owner, start, end)
        removed = np.bincount(owner, end - start, minlength=len(spans)).astype(np.int64)
        count = np.bincount(owner, minlength=len(spans))
        kept = []
        starts, ends = iter(start.tolist()), iter(end.tolist())
        for n, text in zip(count.tolist(), _unpacked(batch.column("packed"))):
            at = 0
            pieces = []
            for begin, at_ in zip(islice(starts, n), islice(ends, n)):
                pieces.append(text[at:begin])
                at = at_
            pieces.append(text[at:])
            kept.append(b"".join(pieces))
        if kept:
            yield _batch(KEPT, batch.column("key"), batch.column("tkey"), removed, count, kept)


def removed_texts(docs: DataFrame, min_len: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows as (doc_id, key, tkey, n_bytes, digest, is_first), and the first rows that lose some of their
    bytes as (key, tkey, n_removed, n_spans, kept)."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), key.alias("key"), text_key(text_col).alias("tkey"), payload(text_col).alias("text")
    )
    heads = rows.select(
        "doc_id", "key", "tkey", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("digest")
    )
    # Rows that repeat id and text: one of them is the first.
    copy = F.row_number().over(Window.partitionBy("key", "tkey").orderBy("digest"))
    heads = saved(heads.withColumn("copy", copy), "heads")
    firsts = saved(heads.groupBy("digest", "n_bytes").agg(F.min("key").alias("first"), F.min("tkey").alias("tkey")), "firsts")
    marked = heads.join(firsts.drop("tkey"), ["digest", "n_bytes"])
    marked = marked.withColumn("is_first", (F.col("key") == F.col("first")) & (F.col("copy") == 1)).drop("first", "copy")

    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    packets = rows.select("tkey", "text").mapInArrow(_anchors(min_len, buckets), ANCHORS)
    places = packets.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_repeated, PLACES)
    listed = places.groupBy("tkey").agg(F.collect_list("places").alias("places"))
    wanted = listed.join(firsts.select("tkey", F.col("first").alias("key")), "tkey")
    wanted = saved(wanted, "wanted")
    texts = rows.select("key", "tkey", "text")

    def packed(some: DataFrame) -> DataFrame:
        return possible(texts, some, "tkey", _packed, PACKED_TEXT).join(some, ["key", "tkey"])

    found = saved(packed(wanted).mapInArrow(_runs_of_repeats(min_len), RUNS), "runs", batch_rows=1000)
    dealt = dealt_runs(found, min_len)
    sent = dealt.filter("gram IS NOT NULL").repartition("gram").sortWithinPartitions("gram")
    spans = sent.mapInArrow(_matches(min_len), SPANS).unionByName(
        dealt.filter("gram IS NULL").select("key", "tkey", F.col("first").alias("start"), (F.col("first") + F.col("size")).alias("end"))
    )
    grouped = spans.groupBy("key", "tkey").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    grouped = saved(grouped, "spans")
    kept = packed(grouped).mapInArrow(_kept, KEPT)
    return marked, kept


def suffix_dedup(docs: DataFrame, min_len: int = MIN_LEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    marked, kept = removed_texts(docs, min_len, id_col, text_col)
    cut = kept.select("key", "tkey", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    cut = cut.groupBy("key", "tkey").agg(F.max("n_removed").alias("n_removed"), F.max("n_spans").alias("n_spans"), F.max("kept_sha256").alias("kept_sha256"))
    both = marked.join(cut, ["key", "tkey"], "left")
    whole = ~F.col("is_first") & (F.col("n_bytes") >= min_len)
    plain = ~F.col("is_first") | F.col("n_removed").isNull()
    return both.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).when(plain, 0).otherwise(F.col("n_removed")).cast("long").alias("n_removed"),
        F.when(whole, 1).when(plain, 0).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).when(plain, F.col("digest")).otherwise(F.col("kept_sha256")).alias("kept_sha256"),
    )
