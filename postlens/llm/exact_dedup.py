"""Exact dedup by deterministic block naming.

The normalised text of a document is cut into fixed-size blocks of bytes. The distinct
blocks are sorted and get integer names; then neighbouring names are joined in pairs
and the distinct pairs named again, until each document has one name. Two documents of
the same number of blocks have the same name exactly if their texts are equal: no step
compares hashes, so the identity is free of collisions.

Only the first pass carries text. Each task keeps one copy of every block it meets and
lets the others point to it, so a block of a large group of copies is shuffled once per
task. Names are (hash bucket, rank in the sorted bucket): sorting is spread over many
buckets, and a re-run gives the same names. Levels are written to the shared folder.
Joins on names keep the skewed side plain, so that adaptive execution can split it.

Edge cases: a null text counts as empty, and equals an empty one. Of equal texts the
row with the smallest id stays; a null id comes after all others; of rows that repeat
id and text one stays. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import keep_rows, lean, payload, saved, text_key

BLOCK_BYTES = 4096
BUCKETS = 1 << 20
NO_NAME = -1
KNOWN_BYTES = 64 << 20
_SPACE = bytes(32 if b in range(9, 14) else b for b in range(256))
CUT_SCHEMA = (
    "row long, id long, tkey long, n_blocks long, pos long, first_row long, first_pos long, block binary, digest string"
)


def normalised(text: bytes) -> bytes:
    """Each run of ASCII white space as one space."""
    text = text.translate(_SPACE)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text


def _cutter(block_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, int]] = {}
        held = 0
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for row, key, tkey, text in zip(*[c.to_pylist() for c in batch.columns]):
                text = normalised(text)
                n = max(1, -(-len(text) // block_bytes))
                for pos in range(n):
                    block = text[pos * block_bytes : (pos + 1) * block_bytes]
                    first = known.get(block)
                    new = first is None
                    if new:
                        if held > KNOWN_BYTES:
                            known.clear()
                            held = 0
                        first = known[block] = (row, pos)
                        held += len(block) + 100
                        size += len(block)
                    digest = hashlib.sha256(text).hexdigest() if pos == 0 else None
                    rows.append((row, key, tkey, n, pos, *first, block if new else None, digest))
                if size > 16 << 20:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return cut


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 7 + [pa.binary(), pa.string()]
    names = [f.split()[0] for f in CUT_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _ranked(values: DataFrame, *columns: str) -> DataFrame:
    """Each value's integer name: its hash bucket and its rank among the sorted values there."""
    bucketed = values.withColumn("bucket", F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)))
    order = Window.partitionBy("bucket").orderBy(*columns)
    return bucketed.withColumn("name", F.col("bucket") * F.lit(1 << 40) + F.dense_rank().over(order)).drop("bucket")


def identities(cuts: DataFrame) -> DataFrame:
    """(row, n_blocks, name): one name for each document."""
    blocks = cuts.filter("block IS NOT NULL").select("first_row", "first_pos", "block")
    names = _ranked(blocks, "block").drop("block")
    level = saved(
        cuts.select("row", "n_blocks", F.col("n_blocks").alias("left"), "pos", "first_row", "first_pos")
        .join(names, ["first_row", "first_pos"])
        .drop("first_row", "first_pos"),
        "names",
    )
    done = level.filter("left = 1")
    while not (rest := level.filter("left > 1")).isEmpty():
        even = F.col("pos") % 2 == 0
        pairs = (
            rest.groupBy("row", "n_blocks", "left", F.expr("pos div 2").alias("pos"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("a"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NO_NAME)).alias("b"),
            )
            .withColumn("left", F.expr("(left + 1) div 2"))
        )
        named = _ranked(pairs.select("a", "b").distinct(), "a", "b")
        level = saved(pairs.join(named, ["a", "b"]).select("row", "n_blocks", "left", "pos", "name"), "names")
        done = done.unionByName(level.filter("left = 1"))
    return done.select("row", "n_blocks", "name")


def classified(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(row, id, tkey, digest, group_size, first) of every row; `first` is the row that stays."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        text_key(text_col).alias("tkey"),
        payload(text_col).alias("text"),
    )
    cuts = saved(rows.mapInArrow(lean(_cutter(block_bytes)), CUT_SCHEMA), "blocks")
    heads = cuts.filter("pos = 0").select("row", "id", "tkey", "digest")
    named = saved(heads.join(identities(cuts), "row"), "identities")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "tkey")
    groups = named.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(place).alias("first"))
    # Written, so that the join's shuffle is for the join alone and a large group in it can be split.
    return named.join(saved(groups, "groups"), ["n_blocks", "name"])


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row."""
    return classified(docs, id_col, text_col, block_bytes).select(
        F.col("id").alias("doc_id"),
        F.col("first.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def kept_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of `docs` that stay, with all columns."""
    found = classified(docs, id_col, text_col, block_bytes)
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tkey") == F.col("first.tkey"))
    return keep_rows(docs, found.filter(stays).select(F.col("id").alias("doc_id"), "tkey"), id_col, text_col)
