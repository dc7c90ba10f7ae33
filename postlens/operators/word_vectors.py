"""Word vectors from counts: what stands near a word, weighted and projected.

Words are numbered, and pairs are counted as numbers. Nothing is gathered in one task,
and no vocabulary goes to the driver: only the counts and drawn places of a block of
words of bounded size at a time, for all tasks. Counts are exact and a vector depends
on the texts, the seed and the sizes alone, so another partitioning gives the same
vectors up to the order of sums.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.session import written

# Functions travel to the workers by value: they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 5
MIN_COUNT = 5
SIZE = 100
NONZEROS = 8
# Bytes of words that a task counts at once, contexts in one pack, rows passed on at once, and words whose numbers are sent to all tasks at once.
SLICE_BYTES = 1 << 24
PACK_CONTEXTS = 1 << 16
BATCH_ROWS = 1 << 14
BLOCK_WORDS = 1 << 21


SLICES = "slice long, code int, word string, n long, codes binary, near binary"
PACKETS = "bucket int, id long, word string, keys binary, counts binary"
COUNTS = "ids array<long>, words array<string>, word_ns array<long>, sizes array<int>, contexts binary, ns binary"


def _codes(window: int, limit: int):
    """Slices of `limit` bytes of (place, word): a row with the words as numbers, and one for each of the words with its count.

    A text may go on in the next slice, which begins with the last `window` words again; they are not counted twice.
    """

    def slice_rows(rows: pa.Table, skip: int) -> Iterator[pa.RecordBatch]:
        name = uuid.uuid4().int >> 65
        coded = rows.column("word").combine_chunks().dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy().astype(np.int32)
        near = np.minimum(rows.column("place").to_numpy(), window).astype(np.int32)
        packed = [_packed(x) for x in (codes, near)]
        yield _batch(SLICES, [name], [None], [None], [skip], [packed[0]], [packed[1]])
        counted = codes[skip:]
        n = np.bincount(counted[counted >= 0], minlength=len(coded.dictionary))
        for at in range(0, len(n), BATCH_ROWS):
            words = coded.dictionary.slice(at, BATCH_ROWS)
            none = pa.nulls(len(words), pa.binary())
            yield _batch(SLICES, [name] * len(words), np.arange(at, at + len(words)), words, n[at : at + BATCH_ROWS], none, none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, skip, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= limit:
                rows = pa.Table.from_batches(held)
                yield from slice_rows(rows, skip)
                skip = min(window, rows.num_rows)
                held, size = rows.slice(rows.num_rows - skip).combine_chunks().to_batches(), 0
        if held:
            yield from slice_rows(pa.Table.from_batches(held), skip)

    return run


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
        "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
    }
    named = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)], [n for n, _ in named])


def _packed(values: np.ndarray) -> bytes:
    """Length, then the compressed bytes."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _steps(contexts: np.ndarray) -> np.ndarray:
    """The differences of contexts, which are small where they are sorted."""
    return np.diff(contexts.astype(np.int32), prepend=np.int32(0))


def _unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd"), kind)


def _pairs(window: int, span: int):
    """(word, context) as numbers with their counts, both ways, in packets for each range of `span` words; input is sorted by slice."""

    def pairs(codes: np.ndarray, near: np.ndarray, skip: int, ids: np.ndarray) -> Iterator[tuple]:
        word = np.r_[ids, -1][codes]
        keys = []
        for k in range(1, min(window, len(word) - 1) + 1):
            # Either word is often, and both stand in one text.
            at = np.flatnonzero((word[k:] >= 0) & (word[:-k] >= 0) & (near[k:] >= k))
            at = at[at + k >= skip]
            one, two = word[at], word[at + k]
            keys += [one << 32 | two, two << 32 | one]
        keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
        counts, keys = np.diff(np.r_[first, len(keys)]), keys[first]
        bucket = (keys >> 32) // span
        border = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(keys)])
        for a, b in zip(border, [*border[1:], len(keys)]):
            # Differences of sorted numbers are small.
            yield bucket[a], None, None, _packed(np.diff(keys[a:b], prepend=0)), _packed(counts[a:b].astype(np.uint32))

    def of_slice(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        code, whole = rows.column("code").combine_chunks(), rows.filter(pc.is_null(rows.column("code"))).to_pylist()
        listed = rows.filter(pc.is_valid(code))
        for row in whole:
            codes, near = _unpacked(row["codes"], np.int32), _unpacked(row["near"], np.int32)
            ids = np.full(max(int(codes.max(initial=-1)) + 1, 0), -1, np.int64)
            ids[listed.column("code").to_numpy()] = listed.column("id").to_numpy()
            found = list(pairs(codes, near, row["n"], ids))
            if found:
                yield _batch(PACKETS, *zip(*found))

    return _sorted_groups("slice", of_slice)


def _sorted_groups(key: str, then: Callable) -> Callable:
    """`then` on all rows of each key, for input that is sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            column = batch.column(key)
            ends = pc.run_end_encode(column).run_ends.to_pylist() if batch.num_rows else []
            for a, b in zip([0, *ends], ends):
                if held and held[-1].column(key)[0] != column[a]:
                    yield from then(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield from then(pa.Table.from_batches(held))
        pa.default_memory_pool().release_unused()

    return run


def _summed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The contexts of the words of a bucket with their counts, in packs of bounded size; a word with more than `BLOCK_WORDS` is in several."""
    named = rows.filter(pc.is_valid(rows.column("id"))).sort_by("id")
    packets = rows.filter(pc.is_valid(rows.column("keys")))
    if not packets.num_rows:
        return
    keys = np.concatenate([np.cumsum(_unpacked(x, np.int64)) for x in packets.column("keys").to_pylist()])
    counts = np.concatenate([_unpacked(x, np.uint32) for x in packets.column("counts").to_pylist()])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    n = np.add.reduceat(counts[order].astype(np.int64), first)
    word, context = keys[first] >> 32, (keys[first] & 0xFFFFFFFF).astype(np.int32)
    start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    total = np.add.reduceat(n, start)
    ids = word[start]
    names = named.column("word").combine_chunks().take(pa.array(np.searchsorted(named.column("id").to_numpy(), ids)))
    size = np.diff(np.r_[start, len(word)])
    parts = -(-size // BLOCK_WORDS)
    owner = np.repeat(np.arange(len(ids)), parts)
    begin = start[owner] + BLOCK_WORDS * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
    ends = np.r_[begin[1:], len(word)]
    at = 0
    while at < len(owner):
        to = max(at + 1, int(np.searchsorted(ends, begin[at] + PACK_CONTEXTS, "right")))
        some, own = slice(begin[at], ends[to - 1]), owner[at:to]
        yield _batch(COUNTS, [ids[own]], [names.take(pa.array(own)).to_pylist()], [total[own]], [(ends - begin)[at:to]], [_packed(_steps(context[some]))], [_packed(n[some])])
        at = to


def _numbered(often: DataFrame) -> tuple[DataFrame, int]:
    """The written words as (id, word), numbered from 0 on, and how many there are. The driver gets a count for each part."""
    rows = written(often.select("word", F.monotonically_increasing_id().alias("at")), "often")
    counts = {r["part"]: r["n"] for r in rows.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = dict(zip(sorted(counts), np.cumsum([0, *[counts[p] for p in sorted(counts)]]).tolist()))
    offsets = rows.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    placed = rows.join(F.broadcast(offsets), F.shiftright("at", 33) == F.col("part"))
    return placed.select((F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("id"), "word"), sum(counts.values())


def pair_counts(
    df: DataFrame, words: str = "filtered", window: int = WINDOW, min_count: int = MIN_COUNT, packed: bool = False
) -> DataFrame:
    """(word, context, n): how often a word stands at most `window` words from another, both ways.

    Words that occur fewer than `min_count` times take up their places but are not counted.
    `packed` gives the written packs (ids, words, word_ns, sizes, contexts, ns) instead: some words,
    and for each of them the numbers of its contexts and how often each occurs.

    A map task turns slices of bounded size into numbers. Of a slice's words, only one of a
    kind is shuffled, to learn whether it is rare and what its number is; pairs are counted
    as numbers slice by slice, and summed up for ranges of words.
    """
    spark = df.sparkSession
    # Not `explode`: see `explode_tokens`. A null word takes up its place.
    placed = df.select(F.posexplode_outer(words).alias("place", "word")).filter("place IS NOT NULL")
    slices = written(placed.mapInArrow(_codes(window, SLICE_BYTES), SLICES), "slices")
    listed = slices.filter("code IS NOT NULL").select("slice", "code", "word", "n")
    often = listed.groupBy("word").agg(F.sum("n").alias("c")).filter(F.col("c") >= min_count)
    vocabulary, size = _numbered(often)
    if size >= 1 << 31:
        raise ValueError("more than 2^31 words")
    span = max(1, -(-size // (4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    known = listed.join(vocabulary, "word").select("slice", "code", "id", F.lit(None).cast("long").alias("n"), *[F.lit(None).cast("binary").alias(c) for c in ("codes", "near")])
    whole = slices.filter("code IS NULL").select("slice", "code", F.lit(None).cast("long").alias("id"), "n", "codes", "near")
    packets = known.unionByName(whole).repartition("slice").sortWithinPartitions("slice").mapInArrow(_pairs(window, span), PACKETS)
    bucket = (F.col("id") / F.lit(span)).cast("int").alias("bucket")
    names = vocabulary.select(bucket, "id", "word", *[F.lit(None).cast("binary").alias(c) for c in ("keys", "counts")])
    dealt = packets.unionByName(names).repartition("bucket").sortWithinPartitions("bucket")
    counts = written(dealt.mapInArrow(_sorted_groups("bucket", _summed), COUNTS), "pair-counts")
    if packed:
        return counts
    names = _words(counts).select("id", F.col("word").alias("context"))
    return counts.mapInArrow(_rows, "word string, id long, n long").join(names, "id").select("word", "context", "n")


def _words(packs: DataFrame) -> DataFrame:
    """(id, word, word_n) of the words of packs."""
    zipped = F.arrays_zip(F.col("ids").alias("id"), F.col("words").alias("word"), F.col("word_ns").alias("word_n"))
    return packs.select(F.inline(zipped)).dropDuplicates(["id"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row, owner, context, n in _entries(batches, 0, 1 << 31, _unpacked, ns=np.int64):
        yield _batch("word string, id long, n long", pa.array(row["words"], pa.string()).take(pa.array(owner)), context, n)


def _with_blocks(packs: DataFrame, table: DataFrame, width: int, then: Callable, schema: str) -> list[DataFrame]:
    """`then(block, first, batches)` for the packs, once for each block of `BLOCK_WORDS` words' numbers: an array of `width` columns.

    `table` is (id, values). A block of bounded size at a time is sent to all tasks.
    """
    spark = packs.sparkSession
    most = table.agg(F.max("id").alias("m")).first()["m"]
    parts = []
    for first in range(0, 1 if most is None else most + 1, BLOCK_WORDS):
        found = table.filter((F.col("id") >= first) & (F.col("id") < first + BLOCK_WORDS)).toArrow()
        values = found.column("values").combine_chunks().flatten().to_numpy()
        block = np.zeros((0 if most is None else min(most + 1 - first, BLOCK_WORDS), width), values.dtype)
        block[found.column("id").to_numpy() - first] = values.reshape(-1, width)
        shared = spark.sparkContext.broadcast(block)
        parts.append(packs.mapInArrow(lambda batches, shared=shared, first=first: then(shared.value, first, batches), schema))
    return parts


def _entries(batches: Iterator[pa.RecordBatch], first: int, n: int, unpacked: Callable, **kinds: type) -> Iterator[tuple]:
    """A pack, and the word's place and values of its entries whose context is among the `n` from `first` on."""
    for batch in batches:
        for i in range(batch.num_rows):
            [row] = batch.slice(i, 1).to_pylist()
            owner = np.repeat(np.arange(len(row["sizes"])), row["sizes"])
            context = np.cumsum(unpacked(row["contexts"], np.int32), dtype=np.int64) - first
            here = (context >= 0) & (context < n)
            yield row, owner[here], context[here], *[unpacked(row[c], kind)[here] for c, kind in kinds.items()]


WEIGHTS = f"{COUNTS}, context_ns binary, ppmi binary"


def _weigh(total: float):
    def weigh(block: np.ndarray, first: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, owner, context, n in _entries(batches, first, len(block), _unpacked, ns=np.int64):
            context_n = block[context, 0]
            by_chance = np.array(row["word_ns"], np.float64)[owner] * context_n / max(total, 1.0)
            ppmi = np.maximum(np.log(n / by_chance), 0.0)
            sizes = np.bincount(owner, minlength=len(row["ids"]))
            # Not compressed, as they are not stored.
            raw = [[x.tobytes()] for x in (_steps(context + first), n, context_n, ppmi)]
            yield _batch(WEIGHTS, *[[row[c]] for c in ("ids", "words", "word_ns")], [sizes], *raw)

    return weigh


def positive_pmi(counts: DataFrame) -> DataFrame:
    """(word, context, n, word_n, context_n, ppmi): the log of how much more often than by chance, at least 0.

    Packed counts give packs with `context_ns` and `ppmi` as well.
    """
    if "contexts" in counts.columns:
        margin = written(_words(counts), "word-counts")
        total = float(margin.agg(F.coalesce(F.sum("word_n"), F.lit(0)).alias("n")).first()["n"])
        return reduce(DataFrame.unionByName, _with_blocks(counts, margin.select("id", F.array("word_n").alias("values")), 1, _weigh(total), WEIGHTS))
    counts = written(counts, "pair-counts")
    margin = written(counts.groupBy("word").agg(F.sum("n").alias("word_n")), "word-counts")
    total = float(margin.agg(F.coalesce(F.sum("word_n"), F.lit(0)).alias("n")).first()["n"])
    by_chance = F.col("word_n").cast("double") * F.col("context_n") / F.lit(max(total, 1.0))
    return (
        counts.join(margin, "word")
        .join(margin.select(F.col("word").alias("context"), F.col("word_n").alias("context_n")), "context")
        .select("word", "context", "n", "word_n", "context_n", F.greatest(F.log(F.col("n") / by_chance), F.lit(0.0)).alias("ppmi"))
    )


SUMS = "word string, n long, contexts long, positive long, weight double, largest double"


def weight_sums(weighted: DataFrame) -> DataFrame:
    """(word, n, contexts, positive, weight, largest) of packed weights: how many contexts, how many of positive weight, their sum and the largest."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, owner, _, ppmi in _entries(batches, 0, 1 << 31, np.frombuffer, ppmi=np.float64):
            some, first, contexts = np.unique(owner, return_index=True, return_counts=True)
            if len(some):
                words = pa.array(row["words"], pa.string()).take(pa.array(some))
                total = np.array(row["word_ns"])[some]
                positive = np.add.reduceat((ppmi > 0).astype(np.int64), first)
                yield _batch(SUMS, words, total, contexts, positive, np.add.reduceat(ppmi, first), np.maximum.reduceat(ppmi, first))

    found = weighted.select("words", "word_ns", "sizes", "contexts", "ppmi").mapInArrow(sums, SUMS)
    return found.groupBy("word").agg(
        F.max("n").alias("n"), F.sum("contexts").alias("contexts"), F.sum("positive").alias("positive"), F.sum("weight").alias("weight"), F.max("largest").alias("largest")
    )


def signature(context: Column, size: int = SIZE, nonzeros: int = NONZEROS, seed: int = 42) -> Column:
    """Where a context adds its weight, and with which sign: `nonzeros` draws from MD5, whatever else there is."""

    def draw(j: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), j.cast("string"), context))
        place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % size
        sign = F.when(F.substring(digest, 9, 1) < "8", 1.0).otherwise(-1.0)
        return F.struct(place.cast("int").alias("place"), sign.alias("sign"))

    return F.transform(F.sequence(F.lit(1), F.lit(nonzeros)), draw)


VECTORS = "word string, x array<double>"


def _project(size: int):
    def project(block: np.ndarray, first: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, owner, context, ppmi in _entries(batches, first, len(block), np.frombuffer, ppmi=np.float64):
            used = ppmi > 0
            some, owner = np.unique(owner[used], return_inverse=True)
            x = np.zeros(len(some) * size)
            for drawn in block[context[used]].T:
                # A draw's place, and in the last bit its sign.
                x += np.bincount(owner * size + (drawn >> 1), ppmi[used] * (2.0 * (drawn & 1) - 1.0), minlength=len(x))
            offsets = pa.array(np.arange(len(some) + 1) * size, pa.int32())
            yield _batch(VECTORS, pa.array(row["words"], pa.string()).take(pa.array(some)), pa.ListArray.from_arrays(offsets, pa.array(x)))

    return project


def projected(weighted: DataFrame, size: int = SIZE, nonzeros: int = NONZEROS, seed: int = 42) -> DataFrame:
    """(word, vector): each word's row of weights through a sparse random projection to `size` numbers."""
    scale = nonzeros**-0.5
    if "contexts" in weighted.columns:
        drawn = F.transform(signature(F.col("word"), size, nonzeros, seed), lambda s: 2 * s["place"] + (s["sign"] > 0).cast("int"))
        signs = written(_words(weighted).select("id", drawn.alias("values")), "signs")
        parts = _with_blocks(weighted.select("words", "sizes", "contexts", "ppmi"), signs, nonzeros, _project(size), VECTORS)
        found = parts[0]
        if len(parts) > 1:  # else a word is in one pack
            added = F.reduce("xs", F.array_repeat(F.lit(0.0), size), lambda a, x: F.zip_with(a, x, lambda p, q: p + q))
            found = reduce(DataFrame.unionByName, parts).groupBy("word").agg(F.collect_list("x").alias("xs")).select("word", added.alias("x"))
        return found.select("word", F.transform("x", lambda x: x * F.lit(scale)).alias("vector"))
    used = weighted.filter("ppmi > 0")
    signs = used.select("context").distinct().withColumn("s", signature(F.col("context"), size, nonzeros, seed))
    drawn = used.join(signs, "context").select("word", "ppmi", F.explode("s").alias("s"))
    summed = drawn.groupBy("word", F.col("s.place").alias("place")).agg(F.sum(F.col("ppmi") * F.col("s.sign")).alias("x"))
    entries = summed.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("place", "x"))).alias("at"))  # `size` at most
    vector = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.try_element_at("at", i), F.lit(0.0)) * F.lit(scale)
    )
    return entries.select("word", vector.alias("vector"))


def fit_word_vectors(
    df: DataFrame, words: str = "filtered", window: int = WINDOW, min_count: int = MIN_COUNT,
    size: int = SIZE, nonzeros: int = NONZEROS, seed: int = 42,
) -> DataFrame:
    """(word, vector) of every word that occurs `min_count` times, written to the shared folder."""
    weighted = positive_pmi(pair_counts(df, words, window, min_count, packed=True))
    return written(projected(weighted, size, nonzeros, seed), "word-vectors")


def mean_vectors(df: DataFrame, vectors: DataFrame, key: str, words: str = "filtered", out: str = "features", size: int = SIZE) -> DataFrame:
    """All rows with the mean vector of their words; words without a vector do not count, a text without any gets zeros.

    `key` is unique. Texts stay where they are: only keys and words are shuffled to the vectors.
    """
    bags = df.select(F.col(key).alias("_key"), F.explode(words).alias("word")).groupBy("_key", "word").agg(F.count(F.lit(1)).alias("n"))
    found = bags.join(vectors.select("word", array_to_vector("vector").alias("v")), "word")
    means = found.groupBy("_key").agg(Summarizer.mean(F.col("v"), F.col("n").cast("double")).alias(out))
    joined = df.drop(out).join(means, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumn(out, F.coalesce(out, array_to_vector(F.array_repeat(F.lit(0.0), size))))
