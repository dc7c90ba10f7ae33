"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.session import new_path

BITMAP_BITS = 1 << 26
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def saved(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """The frame written to the shared folder and read again.

    It cuts the lineage, so that a lost executor repeats no earlier work, and fixes
    ids that were dealt out by partition. `batch_rows` bounds the rows that go to a
    Python function at once, where rows are large.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(BATCH_ROWS)
    if batch_rows is not None:
        spark.conf.set(BATCH_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def lean(function: Callable) -> Callable:
    """A function on batches that leaves no memory behind in its worker, which lives on through later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            # What the allocator keeps; only the GNU library has this call.
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def payload(column: str) -> Column:
    """UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("binary"), F.lit(b""))


def text_key(column: str) -> Column:
    """64 bits of a text, null as empty."""
    return F.xxhash64(payload(column))


def keep_rows(
    docs: DataFrame, kept: DataFrame, id_col: str, text_col: str, repeats: Column | None = None
) -> DataFrame:
    """The rows of `docs`, with all columns, whose (doc_id, tkey) is in `kept`.

    The kept keys are a written table, and Spark's size check decides whether it is sent
    to all tasks or the rows are shuffled to it. `kept` has a row for each row of
    `docs` that may stay; rows that repeat id and text become one, unless `repeats`, a
    condition on `kept`, holds.
    """
    several = F.lit(True) if repeats is None else ~repeats
    keys = kept.groupBy(F.col("doc_id").alias("_kept_id"), F.col("tkey").alias("_kept_key")).agg(
        ((F.count(F.lit(1)) > 1) & F.max(several)).alias("_repeated")
    )
    keys = saved(keys, "kept")
    key = F.xxhash64(F.coalesce(docs[f"`{text_col}`"].cast("binary"), F.lit(b"")))

    def rows(which: DataFrame) -> DataFrame:
        of_docs = docs[f"`{id_col}`"].cast("long")
        same = of_docs.eqNullSafe(which["_kept_id"]) & (key == which["_kept_key"])
        return docs.join(which, same, "left_semi")

    repeated = keys.filter("_repeated")
    if repeated.isEmpty():
        return rows(keys)
    once = rows(repeated).withColumn("_once_key", text_key(text_col)).dropDuplicates([id_col, "_once_key"]).drop("_once_key")
    return rows(keys.filter("NOT _repeated")).unionByName(once)


def possible(
    rows: DataFrame, wanted: DataFrame, key: str, then: Callable | None = None, schema: str | None = None
) -> DataFrame:
    """The rows whose 64-bit key may be among the wanted ones, to join the rest with fewer bytes.

    A bitmap of fixed size, whatever the data, marks the wanted keys by their low bits.
    It never drops a wanted row; the more keys there are, the fewer rows it can drop.
    `then` works on the batches that are left, in the same Python process.
    """
    place = F.col(key).bitwiseAND(F.lit(BITMAP_BITS - 1))
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63))
    table = wanted.select(word.alias("word"), bit.cast("int").alias("bit")).groupBy("word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits")
    ).toArrow()
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    bitmap[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def marked_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            low = batch.column(key).to_numpy() & (BITMAP_BITS - 1)
            yield batch.filter(pa.array((bits[low >> 6] >> (low & 63) & 1).astype(bool)))

    if then is None:
        return rows.mapInArrow(lean(marked_only), rows.schema)
    return rows.mapInArrow(lean(lambda batches: then(marked_only(batches))), schema)


def packs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to `limit` at most, or of one larger item."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def smaller(batches: Iterator[pa.RecordBatch], column: str | int, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices with about `limit` bytes of a text column at most, or one row."""
    for batch in batches:
        for a, b in packs(pc.binary_length(batch.column(column)).fill_null(0).to_pylist(), limit):
            yield batch.slice(a, b - a)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers (wraps round)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
