"""Hard negatives of anchors by exact integer scores, multiplied in tiles after Strassen.

Anchors and candidates are dealt to blocks of bounded size by a hash of a row number, so no
label, id or group of copies can fill one. Every anchor block meets every candidate block
in a cell of its own, joined on (anchor block, candidate block): a stated query set against
all rows, in blocks. A cell cuts its blocks in square tiles and multiplies them with seven
half-size products instead of eight, down to leaves; odd sides are padded with zeros.

Where no number on the way can exceed 2**53, as with components of ordinary size, the
products are taken in doubles, which is exact and many times faster. Otherwise they are
taken in 64-bit integers: sums and differences wrap round and come back, so a product is
exact whenever the scores themselves fit, which the quantisation ensures.

Blocks grow with the tables, up to a limit, so that a row is copied to few cells, and carry
components in the fewest bytes that hold them. Positives are looked for among the rows of
the anchor's label only; a block holds its rows in the order of labels.

Two rounds, each with a heap of bounded size per anchor that merges over tiles, cells and
tasks:
1. positives: the best rows of the anchor's label;
2. windows: for each positive, the best rows of another label whose score lies in the
   window that the positive's score spans. The scores are multiplied again rather than
   written: all scores of all anchors would be the largest table of the job.

Edge cases: rows with a null id, label or vector, or a null or non-finite component take no
part. Vectors of different lengths score as if the shorter were padded with zeros; an empty
one scores 0 with all. A component beyond what keeps scores in 64 bits (about 1.5 million
at 64 components) counts as that largest value. Rows that repeat an id are rows of their
own: each is a candidate, and an anchor if its id makes it one. A negative positive score
has an empty window. A missing label on all sides, one label only, or an empty table gives
no rows. Only id, vector and label are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import lean, saved

ANCHOR_BLOCK = 1024
CANDIDATE_BLOCK = 4096
# Larger tables are cut in about so many blocks, until a block has so many components.
ANCHOR_BLOCKS = 4
CANDIDATE_BLOCKS = 64
BLOCK_COMPONENTS = 1 << 22
TILE = 512
LEAF = 32
EXACT = 1 << 53
NONE = np.iinfo(np.int64).min
LAST = np.iinfo(np.int64).max
PACKED = "block long, rows long, uids binary, ids binary, labels binary, vectors binary, bars binary"
HITS = "anchor long, place int, uid long, vec_id long, score long"


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b.T for matrices of int64, or of whole doubles, rows against rows, by Strassen's seven products."""
    if min(a.shape[0], b.shape[0], a.shape[1]) <= leaf:
        return a @ b.T
    rows, cols = a.shape[0], b.shape[0]
    a, b = _even(a), _even(b)
    m, n, k = a.shape[0] // 2, b.shape[0] // 2, a.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    # b is held row by row: its upper right quarter is the lower left one of its transpose.
    b11, b21, b12, b22 = b[:n, :k], b[:n, k:], b[n:, :k], b[n:, k:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m, 2 * n), a.dtype)
    out[:m, :n] = p1 + p4 - p5 + p7
    out[:m, n:] = p3 + p5
    out[m:, :n] = p2 + p4
    out[m:, n:] = p1 - p2 + p3 + p6
    return out[:rows, :cols]


def exact_in_doubles(most_a: int, most_b: int, width: int, rows: int, leaf: int = LEAF) -> bool:
    """Whether Strassen's products of vectors with components up to these stay whole numbers in doubles.

    A level doubles the numbers on either side and halves what is summed; four products of it are added.
    """
    levels, least = 0, min(rows, width)
    while least > leaf:
        levels, least = levels + 1, (least + 1) // 2
    return most_a * most_b * (width + 2**levels) * 16**levels < EXACT


def _even(x: np.ndarray) -> np.ndarray:
    """Padded with zeros to even sides."""
    odd = (x.shape[0] & 1, x.shape[1] & 1)
    return np.pad(x, ((0, odd[0]), (0, odd[1]))) if any(odd) else x


def _places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the marks, of which there are few."""
    return np.divmod(np.flatnonzero(marks.ravel()), max(1, marks.shape[1]))


class Heaps:
    """For each of `n` anchors the `k` best (score, id) seen: larger scores first, then smaller ids.

    Heaps of different rows of the data merge by adding the one's entries to the other.
    """

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.full((n, k), NONE)
        self.id = np.zeros((n, k), np.int64)
        self.uid = np.zeros((n, k), np.int64)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        """Scores of anchors from `first` on against some candidates; NONE where a pair does not count."""
        last = first + len(scores)
        floor = np.maximum(self.score[first:last, -1], NONE + 1)
        if self.k < scores.shape[1] and (floor == NONE + 1).any():
            # What is not among a row's best here cannot be among its best of all.
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, col = _places(scores >= floor[:, None])
        self.put(first, row, scores[row, col], ids[col], uids[col])

    def put(self, first: int, row: np.ndarray, scores: np.ndarray, ids: np.ndarray, uids: np.ndarray) -> None:
        """One entry for each of the anchors `first + row`."""
        if not len(row):
            return
        touched = np.unique(row)
        old_row, old_col = np.nonzero(self.score[first + touched] != NONE)
        old_row = touched[old_row]
        all_rows = np.r_[old_row, row]
        score = np.r_[self.score[first + old_row, old_col], scores]
        id_ = np.r_[self.id[first + old_row, old_col], ids]
        uid = np.r_[self.uid[first + old_row, old_col], uids]
        order = np.lexsort((uid, id_, -score, all_rows))
        all_rows, score, id_, uid = all_rows[order], score[order], id_[order], uid[order]
        starts = np.flatnonzero(np.r_[True, all_rows[1:] != all_rows[:-1]])
        place = np.arange(len(all_rows)) - np.repeat(starts, np.diff(np.r_[starts, len(all_rows)]))
        best = place < self.k
        at = (first + all_rows[best], place[best])
        self.score[at], self.id[at], self.uid[at] = score[best], id_[best], uid[best]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, id, uid, score) of all that was kept."""
        row, col = np.nonzero(self.score != NONE)
        return row, self.id[row, col], self.uid[row, col], self.score[row, col]


def quantised(
    df: DataFrame, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256
) -> DataFrame:
    """(uid, vec_id, label, q): integer components of the rows that take part, with a row number, written once."""
    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < F.lit(math.inf)))
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        (F.col(f"`{label_col}`") if label is None else label).cast("long").alias("label"),
        F.when(finite, x).alias("x"),
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    wide = F.transform("x", lambda v: F.floor(v.cast("double") * scale))
    return saved(rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", "label", wide.alias("q")), "vectors")


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same numbers in the fewest bytes."""
    low, high = (int(x.min()), int(x.max())) if x.size else (0, 0)
    return x.astype(next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _matrix(data: pa.Buffer, rows: int, width: int) -> np.ndarray:
    """What `_narrow` wrote."""
    return np.frombuffer(data, f"<i{len(data) // (rows * width)}").reshape(rows, width)


def _blocks(rows: DataFrame, size: int, width: int, total: int) -> DataFrame:
    """Rows dealt by a hash of their number to blocks of about `size` rows, one row each, components padded and bounded.

    `rows` may carry `bars`, an array of positive scores.
    """
    count = max(1, math.ceil(total / size))
    most = math.isqrt((2**63 - 1) // max(1, width))

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("uid", "ascending")])
        uids, ids, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("uid", "vec_id", "label"))
        lists = table.column("q").combine_chunks()
        lengths = lists.value_lengths().to_numpy().astype(np.int64)
        vectors = np.zeros((len(uids), width), np.int64)
        vectors[np.arange(width) < lengths[:, None]] = np.clip(lists.flatten().to_numpy(), -most, most)
        # A heap of positives travels with its anchors: at most as many scores as were asked for.
        bars = table.column("bars").to_pylist()
        deep = max((len(b) for b in bars if b), default=0)
        padded = np.array([[*(b or []), *[NONE] * (deep - len(b or []))] for b in bars], np.int64).reshape(len(uids), deep)
        cells = [x.astype("<i8").tobytes() for x in (uids, ids, labels)] + [_narrow(vectors).tobytes(), padded.astype("<i8").tobytes()]
        return pa.table([[key[0].as_py()], [len(uids)], *[pa.array([c], pa.binary()) for c in cells]], names=[f.split()[0] for f in PACKED.split(", ")])

    if "bars" not in rows.columns:
        rows = rows.withColumn("bars", F.lit(None).cast("array<bigint>"))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(count)))
    return dealt.groupBy("block").applyInArrow(pack, PACKED)


def _cells(anchors: DataFrame, n_anchor_blocks: int, candidates: DataFrame, n_candidate_blocks: int) -> DataFrame:
    """One row per pair of blocks: each block is copied once for each block of the other side."""
    names = ("rows", "uids", "ids", "labels", "vectors", "bars")
    left = anchors.select(F.col("block").alias("g"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_candidate_blocks - 1).cast("long"))).alias("r"), *[F.col(c).alias(f"a_{c}") for c in names])
    right = candidates.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_anchor_blocks - 1).cast("long"))).alias("g"), F.col("block").alias("r"), *[F.col(c).alias(f"c_{c}") for c in names])
    # The copies of a small side are many times its size: they are shuffled and not sent to all tasks.
    return left.join(right.hint("merge"), ["g", "r"])


Search = Callable[[dict, dict], Iterator[tuple[int, Heaps]]]


def _searched(cells: DataFrame, width: int, search: Search) -> DataFrame:
    """(anchor, place, uid, vec_id, score): the entries of the heaps that `search` fills in each cell."""

    def side(batch: pa.RecordBatch, i: int, name: str) -> dict:
        n = batch.column(f"{name}_rows")[i].as_py()
        got = {c: np.frombuffer(batch.column(f"{name}_{c}")[i].as_buffer(), "<i8") for c in ("uids", "ids", "labels", "bars")}
        return got | {"vectors": _matrix(batch.column(f"{name}_vectors")[i].as_buffer(), n, width), "bars": got["bars"].reshape(n, -1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                anchors = side(batch, i, "a")
                for place, heaps in search(anchors, side(batch, i, "c")):
                    row, ids, uids, scores = heaps.entries()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchors["uids"][row]), pa.array(np.full(len(row), place, np.int32)), pa.array(uids), pa.array(ids), pa.array(scores)],
                        ["anchor", "place", "uid", "vec_id", "score"],
                    )

    return cells.mapInArrow(lean(run), HITS)


def _factors(anchors: dict, candidates: dict) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of both sides, as doubles if that is exact, else as int64."""
    one, two = anchors["vectors"], candidates["vectors"]
    most = [max(int(x.max()), -int(x.min())) if x.size else 0 for x in (one, two)]
    kind = np.float64 if exact_in_doubles(*most, one.shape[1], TILE) else np.int64
    return one.astype(kind), two.astype(kind)


def _tiles(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[slice, slice, np.ndarray]]:
    for a in range(0, len(first), TILE):
        for c in range(0, len(second), TILE):
            one, two = slice(a, a + TILE), slice(c, c + TILE)
            yield one, two, strassen(first[one], second[two])


def _runs(labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(label, start, end) of each run of equal labels."""
    edges = np.flatnonzero(np.r_[True, labels[1:] != labels[:-1], True]) if len(labels) else []
    yield from ((int(labels[a]), int(a), int(b)) for a, b in zip(edges, edges[1:]))


def _positives(k: int) -> Search:
    def search(anchors: dict, candidates: dict) -> Iterator[tuple[int, Heaps]]:
        heaps = Heaps(len(anchors["uids"]), k)
        first, second = _factors(anchors, candidates)
        others = {label: (a, b) for label, a, b in _runs(candidates["labels"])}
        for label, a, b in _runs(anchors["labels"]):
            c, d = others.get(label, (0, 0))
            for one, two, scores in _tiles(first[a:b], second[c:d]):
                uids = candidates["uids"][c:d][two]
                itself = anchors["uids"][a:b][one, None] == uids
                scores = scores.astype(np.int64)
                scores[itself] = NONE
                heaps.add(a + one.start, scores, candidates["ids"][c:d][two], uids)
        yield 0, heaps

    return search


def _windows(k: int, low: int, high: int, of: int) -> Search:
    """For the p-th positive score s: low*s <= of*score <= high*s."""

    def search(anchors: dict, candidates: dict) -> Iterator[tuple[int, Heaps]]:
        bars = anchors["bars"]
        if not bars.size:
            return
        heaps = [Heaps(len(bars), k) for _ in range(bars.shape[1])]
        # Bounds by whole and rest, so that no product leaves 64 bits.
        whole, rest = np.divmod(bars, of)
        least = whole * low - (-rest * low) // of
        most = whole * high + rest * high // of
        # No score lies in an empty window, such as that of a missing or a negative positive.
        shut = (bars == NONE) | (least > most)
        first, second = _factors(anchors, candidates)
        for one, two, scores in _tiles(first, second):
            # A full heap raises the bar: what scores less cannot come in.
            floors = np.stack([np.maximum(least[one, p], heap.score[one, -1]) for p, heap in enumerate(heaps)])
            lowest = np.where(shut[one].T, LAST, floors).min(axis=0, initial=LAST)
            highest = np.where(shut[one], NONE, most[one]).max(axis=1, initial=NONE)
            # Few scores lie in any window that is still open; only these are looked at window by window.
            row, col = _places((scores >= _bound(lowest, scores)) & (scores <= _bound(highest, scores)))
            other = anchors["labels"][one][row] != candidates["labels"][two][col]
            row, col = row[other], col[other]
            found = scores[row, col].astype(np.int64)
            ids, uids = candidates["ids"][two][col], candidates["uids"][two][col]
            for p, heap in enumerate(heaps):
                within = ~shut[one, p][row] & (found >= floors[p][row]) & (found <= most[one, p][row])
                heap.put(one.start, row[within], found[within], ids[within], uids[within])
        yield from enumerate(heaps)

    return search


def _bound(limits: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Limits as a column of the scores' type. Doubles are scores below 2**53, so limits beyond that stand for it."""
    if scores.dtype == np.float64:
        limits = np.clip(limits, -EXACT, EXACT)
    return limits.astype(scores.dtype)[:, None]


def _best(hits: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of each key, ranked; Spark cuts each task's part before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "uid")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, of: int = 100,
    anchor_block: int | None = None, candidate_block: int | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), with the rows' numbers.

    `rows` as `quantised` gives them; `low`, `high` and `of` are whole numbers from 0 on, `low` at most `high`.
    A window is low*p <= of*score <= high*p for the positive's score p.
    """
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("q")).alias("width")).first()
    width = max(1, size.width or 0)
    anchor_block = anchor_block or max(ANCHOR_BLOCK, math.ceil(size.anchors / ANCHOR_BLOCKS))
    candidate_block = candidate_block or max(CANDIDATE_BLOCK, math.ceil(size.n / CANDIDATE_BLOCKS))
    # Long vectors make blocks of fewer rows.
    anchor_block, candidate_block = (max(1, min(n, BLOCK_COMPONENTS // width)) for n in (anchor_block, candidate_block))
    parts = {"anchors": max(1, math.ceil(size.anchors / anchor_block)), "all": max(1, math.ceil(size.n / candidate_block))}
    candidates = saved(_blocks(rows, candidate_block, width, size.n), "candidate-blocks", batch_rows=4)
    anchors = rows.filter(is_anchor)

    def search(of_anchors: DataFrame, how: Search, name: str) -> DataFrame:
        blocks = saved(_blocks(of_anchors, anchor_block, width, size.anchors), "anchor-blocks")
        cells = _cells(blocks, parts["anchors"], candidates, parts["all"])
        return saved(_searched(cells, width, how), name, batch_rows=4)

    hits = search(anchors, _positives(positives), "positives")
    found = _best(hits, ["anchor"], positives).select(
        "anchor", (F.col("rank") - 1).alias("place"), F.col("uid").alias("positive"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    found = saved(found, "positives")
    # At most `positives` scores an anchor, in the order of their places.
    bars = found.groupBy(F.col("anchor").alias("uid")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"]).alias("bars"))
    hits = search(anchors.join(bars, "uid"), _windows(negatives, low, high, of), "negatives")
    ranked = _best(hits, ["anchor", "place"], negatives)
    named = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return ranked.join(found, ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"), F.col("anchor").alias("anchor_row"), F.col("positive").alias("positive_row"), F.col("uid").alias("negative_row"),
    )
