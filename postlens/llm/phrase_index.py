"""Benchmark decontamination with a positional inverted index of the training texts.

1. `build_index` stores the postings of all words of all documents: the documents of a task
   are cut in chunks, and a chunk has a row per term with the places where it occurs. A
   phrase lies within a document and a document within a chunk, so no posting is shuffled
   to build it. One more row per chunk names its documents.
2. The distinct test windows get their terms' frequencies from the index. A window is sent
   to the chunks that have its rarest term, where it meets the lists of the test terms.
3. There the lists, each moved back by its term's offset, are intersected from the rarest
   term on; what is left are the starts of exact matches. For proximity the same lists are
   narrowed from the rarest term on to neighbourhoods that have all terms.

Places count the words of a chunk with one place left free after each document, so no
phrase runs from one into the next. Windows are dealt to slots of bounded size, so a large
benchmark does not meet a chunk in one task.

Edge cases: null or empty texts and those without a word are documents, or items, without
words; an item without words has no window. Items without an id take no part, rows that
repeat an item's id are one item with the windows of all. Documents without an id, or that
repeat one, are rows of their own. A very long document is a chunk of its own. The list of
items of a document is gathered in one row: it is bounded by the benchmark, not by the
documents. Only ids and texts are read, so other columns cannot clash. Empty tables give no
rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import lean, packs, payload, saved

CHUNK_BYTES = 1 << 23
ROWS_AT_ONCE = 2000
TERMS_AT_ONCE = 1 << 14
SLOT_WINDOWS = 1 << 16
INDEX = "chunk long, term string, n long, places binary, docs array<long>, sizes array<long>"
FOUND = "chunk long, doc long, window long, first long, last long"
# What is between words, after A-Z have become a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_IN_WORD = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])


def words_of(column: str) -> Column:
    """The words of a text, in order; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(f"`{column}`"), F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


# --- index ----------------------------------------------------------------


def _invert(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(terms, occurrences of each, places by term, words of each text) of some texts."""
    data = np.frombuffer(b"\0".join([*texts, b""]).translate(_FOLD), np.uint8)
    inside = _IN_WORD[data]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    start, end = edges[::2], edges[1::2]
    below = np.searchsorted(start, np.cumsum([len(t) + 1 for t in texts]))
    sizes = np.diff(np.r_[0, below])
    # The words without what is between them are the values of one Arrow array.
    offsets = np.r_[0, np.cumsum(end - start)].astype(np.int32)
    spelled = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside]))
    coded = spelled.dictionary_encode()
    code = coded.indices.to_numpy()
    place = np.arange(len(code), dtype=np.int64) + np.repeat(np.arange(len(texts)), sizes)
    return coded.dictionary, np.bincount(code, minlength=len(coded.dictionary)), place[np.argsort(code, kind="stable")], sizes


def _packed(places: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Steps from place to place in each list, the first from zero."""
    steps = np.diff(places, prepend=0)
    starts = np.cumsum(counts) - counts
    steps[starts] = places[starts]
    return steps.astype("<u4")


def places_of(steps: bytes) -> np.ndarray:
    """The ascending places of a stored list."""
    return np.cumsum(np.frombuffer(steps, "<u4"), dtype=np.int64)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The positional index of all texts, written to the shared folder.

    A row has a term of a chunk, how often it occurs there and where. The row without a
    term has the chunk's documents and the number of their words.
    """
    schema = pa.schema([("chunk", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("places", pa.binary()), ("docs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            lengths = pc.binary_length(texts).to_pylist()
            for a, b in packs(lengths, chunk_bytes):
                terms, counts, places, sizes = _invert(texts.slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) for c, t in zip(([chunk], [None], [int(sizes.sum())], [None], [ids.slice(a, b - a).to_pylist()], [sizes.tolist()]), schema)], schema=schema
                )
                steps = _packed(places, counts)
                bounds = np.r_[0, np.cumsum(counts)]
                for at in range(0, len(terms), TERMS_AT_ONCE):
                    to = min(len(terms), at + TERMS_AT_ONCE)
                    part = steps[bounds[at] : bounds[to]]
                    offsets = ((bounds[at : to + 1] - bounds[at]) * 4).astype(np.int32)
                    lists = pa.BinaryArray.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(offsets), pa.py_buffer(part)])
                    none = pa.nulls(to - at, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(to - at, chunk)), terms.slice(at, to - at), pa.array(counts[at:to]), lists, none, none], schema=schema)
                chunk += 1

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), payload(text_col).alias("text"))
    return saved(rows.mapInArrow(lean(index), INDEX), "phrase-index", batch_rows=ROWS_AT_ONCE)


def documents_of(index: DataFrame) -> DataFrame:
    """(chunk, doc, doc_id, n_words): the documents of an index, `doc` counts within the chunk."""
    listed = index.filter("term IS NULL").select("chunk", F.posexplode(F.arrays_zip("docs", "sizes")).alias("doc", "one"))
    return listed.select("chunk", F.col("doc").cast("long").alias("doc"), F.col("one.docs").alias("doc_id"), F.col("one.sizes").alias("n_words"))


# --- test windows ---------------------------------------------------------


def item_windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(window, terms) of the distinct windows of `size` words, and (window, item_id). A shorter item is one window."""
    spelled = items.filter(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("item_id"), words_of(text_col).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))
    cut = spelled.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at"), F.lit(size)).alias("terms")).distinct()
    cut = saved(cut, "item-windows")
    windows = saved(cut.select("terms").distinct().select(F.monotonically_increasing_id().alias("window"), "terms"), "windows")
    return windows, cut.join(windows, "terms").select("window", "item_id")


# --- search ---------------------------------------------------------------


class Chunk:
    """The lists of a chunk's test terms, and its documents."""

    def __init__(self, lists: pa.Table) -> None:
        self.stored = {}
        self.known: dict[str, np.ndarray] = {}
        for term, places, sizes in zip(*(lists.column(c).to_pylist() for c in ("term", "places", "sizes"))):
            if term is None:
                self.starts = np.r_[0, np.cumsum(np.array(sizes, np.int64) + 1)]
            else:
                self.stored[term] = places

    def places(self, term: str) -> np.ndarray | None:
        if term not in self.known:
            if term not in self.stored:
                return None
            self.known[term] = places_of(self.stored.pop(term))
        return self.known[term]

    def document(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1


def _member(sorted_list: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of `wanted` are in the list."""
    at = np.searchsorted(sorted_list, wanted)
    at[at == len(sorted_list)] = 0
    return sorted_list[at] == wanted


def phrase_starts(chunk: Chunk, terms: list[str], order: list[int]) -> np.ndarray:
    """Places where `terms` begin in a row: offset-adjusted lists intersected in the given order of offsets."""
    starts = None
    for offset in order:
        places = chunk.places(terms[offset])
        if places is None:
            return np.zeros(0, np.int64)
        if starts is None:
            starts = places - offset
        else:
            starts = starts[_member(places, starts + offset)]
        if not len(starts):
            break
    return starts[starts >= 0]


def near_spans(chunk: Chunk, terms: list[str], order: list[int], within: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) places of the smallest spans of at most `within` words that hold all of `terms`, in any order."""
    nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
    distinct = list(dict.fromkeys(terms[o] for o in order))
    lists = [chunk.places(t) for t in distinct]
    if any(x is None for x in lists):
        return nothing
    centre = lists[0]
    for places in lists[1:]:
        at = np.searchsorted(places, centre - (within - 1))
        at[at == len(places)] = len(places) - 1
        centre = centre[np.abs(places[at] - centre) < within]
        if not len(centre):
            return nothing
    # Every span holds a place of the rarest term; a start is a place of any term shortly before one.
    starts = []
    for places in lists:
        low, high = np.searchsorted(places, centre - (within - 1)), np.searchsorted(places, centre, "right")
        many = high - low
        starts.append(places[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())])
    first = np.unique(np.concatenate(starts))
    last = first
    for places in lists:
        at = np.searchsorted(places, first)
        held = at < len(places)
        first, last, at = first[held], last[held], at[held]
        last = np.maximum(last, places[at])
    fits = (last - first < within) & (chunk.document(first) == chunk.document(last))
    first, last = first[fits], last[fits]
    smallest = np.r_[last[1:] != last[:-1], True] if len(last) else np.zeros(0, bool)
    return first[smallest], last[smallest]


def _joined(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and adjoining spans made one."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    opens = np.r_[True, first[1:] > last[:-1] + 1]
    return first[opens], last[np.r_[opens[1:], True]]


def _planned(index: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists of test terms, and (window, terms, order, rarest) of the windows whose terms all occur."""
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    lists = saved(index.filter("term IS NOT NULL").join(saved(vocabulary, "test-terms"), "term", "left_semi"), "test-lists")
    counts = lists.groupBy("term").agg(F.sum("n").alias("n"))
    spelled = windows.select("window", F.posexplode("terms").alias("offset", "term")).join(counts, "term")
    ordered = spelled.groupBy("window").agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("by_count"))
    plan = windows.join(ordered, "window").filter("size(by_count) = size(terms)").select(
        "window", "terms", F.col("by_count.offset").alias("order"), F.col("by_count")[0]["term"].alias("rarest")
    )
    return lists, saved(plan, "window-plans")


Search = Callable[[Chunk, list[str], list[int]], tuple[np.ndarray, np.ndarray]]


def _search(index: DataFrame, windows: DataFrame, find: Search, merged: bool, slot_windows: int) -> DataFrame:
    """`find` for every window in every chunk that has its rarest term.

    With `merged` there is a row for each document and window with a match, without places,
    and rows without a window for the places that all windows of a slot cover together;
    else a row for each match.
    """
    lists, plan = _planned(index, windows)
    slots = max(1, -(-plan.count() // slot_windows))
    schema = pa.schema([("chunk", pa.int64()), ("doc", pa.int64()), ("window", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(key: tuple, held: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if wanted.num_rows:
            chunk = Chunk(held)
            for window, terms, order in zip(*(wanted.column(c).to_pylist() for c in ("window", "terms", "order"))):
                first, last = find(chunk, terms, order)
                if len(first):
                    out.append((window, first, last))
        if not out:
            return schema.empty_table()
        sizes = [len(f) for _, f, _ in out]
        window = np.repeat(np.array([w for w, _, _ in out], np.int64), sizes)
        first, last = np.concatenate([f for _, f, _ in out]), np.concatenate([x for _, _, x in out])
        doc = chunk.document(first)
        if not merged:
            start = chunk.starts[doc]
            return pa.table([np.full(len(doc), key[0].as_py()), doc, window, first - start, last - start], schema=schema)
        pairs = np.unique(np.stack([doc, window]), axis=1)
        first, last = _joined(first, last)
        doc = chunk.document(first)
        start = chunk.starts[doc]
        n = len(doc) + pairs.shape[1]
        none, no_window = pa.nulls(pairs.shape[1], pa.int64()), pa.nulls(len(doc), pa.int64())
        return pa.table(
            [
                pa.array(np.full(n, key[0].as_py())),
                pa.array(np.r_[pairs[0], doc]),
                pa.chunked_array([pa.array(pairs[1]), no_window]),
                pa.chunked_array([none, pa.array(first - start)]),
                pa.chunked_array([none, pa.array(last - start)]),
            ],
            schema=schema,
        )

    heads = index.filter("term IS NULL")
    every_slot = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot")
    columns = ["chunk", "term", "places", "sizes"]
    held = lists.select(*columns, every_slot).unionByName(heads.select(*columns, every_slot))
    slot = F.pmod(F.col("window"), F.lit(slots)).alias("in_slot")
    wanted = lists.select(F.col("chunk").alias("in_chunk"), F.col("term").alias("rarest")).join(plan, "rarest")
    wanted = wanted.select("in_chunk", slot, "window", "terms", "order")
    cells = held.groupBy("chunk", "slot").cogroup(wanted.groupBy("in_chunk", "in_slot"))
    return saved(cells.applyInArrow(run, FOUND), "window-matches")


def phrase_matches(index: DataFrame, windows: DataFrame, merged: bool = False, slot_windows: int = SLOT_WINDOWS) -> DataFrame:
    """(chunk, doc, window, first, last): exact matches, as word numbers within the document."""

    def find(chunk: Chunk, terms: list[str], order: list[int]) -> tuple[np.ndarray, np.ndarray]:
        starts = phrase_starts(chunk, terms, order)
        return starts, starts + (len(terms) - 1)

    return _search(index, windows, find, merged, slot_windows)


def proximity_matches(index: DataFrame, windows: DataFrame, within: int, merged: bool = False, slot_windows: int = SLOT_WINDOWS) -> DataFrame:
    """(chunk, doc, window, first, last): smallest spans of at most `within` words with all words of a window, in any order.

    A word that a window repeats has to be there once.
    """
    return _search(index, windows, lambda chunk, terms, order: near_spans(chunk, terms, order, within), merged, slot_windows)


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, chunk_bytes: int = CHUNK_BYTES, slot_windows: int = SLOT_WINDOWS) -> DataFrame:
    """One row per document: its words, those inside of a test window, and the items that have a window there."""
    index = build_index(docs, chunk_bytes=chunk_bytes)
    windows, owners = item_windows(items, size)
    found = phrase_matches(index, windows, merged=True, slot_windows=slot_windows)
    # Slots may cover the same words: a span counts what no earlier one has reached.
    earlier = Window.partitionBy("chunk", "doc").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest(F.col("first"), F.coalesce(F.max("last").over(earlier) + 1, F.col("first")))
    spans = found.filter("window IS NULL").select("chunk", "doc", F.greatest(F.col("last") + 1 - reached, F.lit(0)).alias("new"))
    hits = spans.groupBy("chunk", "doc").agg(F.sum("new").alias("n_hit"))
    named = found.filter("window IS NOT NULL").join(owners, "window").select("chunk", "doc", F.col("item_id").cast("string").alias("item")).distinct()
    listed = named.groupBy("chunk", "doc").agg(F.count(F.lit(1)).alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("items"))
    return (
        documents_of(index)
        .join(hits, ["chunk", "doc"], "left")
        .join(listed, ["chunk", "doc"], "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
            F.sha2(F.coalesce("items", F.lit("")).cast("binary"), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def near_matches(docs: DataFrame, items: DataFrame, size: int = 10, within: int = 20, chunk_bytes: int = CHUNK_BYTES, slot_windows: int = SLOT_WINDOWS) -> DataFrame:
    """(doc_id, item_id, n_spans, first, last): documents with all words of a test window close together, in any order.

    `first` and `last` are word numbers of the earliest smallest span.
    """
    index = build_index(docs, chunk_bytes=chunk_bytes)
    windows, owners = item_windows(items, size)
    found = proximity_matches(index, windows, within, slot_windows=slot_windows).join(owners, "window")
    spans = found.groupBy("chunk", "doc", "item_id", "first", "last").agg(F.count(F.lit(1)).alias("n"))
    each = spans.groupBy("chunk", "doc", "item_id").agg(
        F.count(F.lit(1)).alias("n_spans"), F.min(F.struct("first", "last")).alias("span")
    )
    return each.join(documents_of(index), ["chunk", "doc"]).select("doc_id", "item_id", "n_spans", "span.first", "span.last")
