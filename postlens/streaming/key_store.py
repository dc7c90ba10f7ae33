"""Keys of all earlier batches, kept so that a batch rereads only what may repeat.

Every batch has its keys in hash buckets, a folder each, and next to them a Bloom filter for
each bucket. A new batch meets the filters of its own buckets; only bucket folders whose
filter lets one of its keys through are opened, and there the keys themselves decide. So
what a batch opens follows its repeats, not the history: without repeats it is the
filters, about three bytes a key, and next to nothing else.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions travel to the workers by value: they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 16
BITS_A_KEY = 24
# In a shorter filter the steps of two keys coincide too often.
LEAST_BITS = 1 << 13
HASHES = 8
FILTERS = "bucket int, n long, bits binary"


def bucket_of(hashed: Column, buckets: int) -> Column:
    return F.pmod(hashed, F.lit(buckets)).cast("int")


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key, a row of `HASHES`: steps of one half of the hash from the other."""
    h = hashes.view(np.uint64)
    # Buckets took the low bits, so they are stirred in before they are used.
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    first, step = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    size = max(LEAST_BITS, BITS_A_KEY * len(hashes)) // 8 * 8
    bits = np.zeros(size, np.uint8)
    bits[_places(hashes, size).ravel()] = 1
    return np.packbits(bits).tobytes()


def passes(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold; one that it holds always passes."""
    packed = np.frombuffer(bits, np.uint8)
    at = _places(hashes, 8 * len(packed))
    return ((packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=1)


def _filter(key: tuple, table: pa.Table) -> pa.Table:
    hashes = table.column("hash").to_numpy()
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "n": [len(hashes)], "bits": pa.array([bloom(hashes)], pa.binary())})


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "hashes": pa.array([table.column("hash").to_numpy().tobytes()], pa.binary())})


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hit = [
            bool(passes(bits, np.frombuffer(hashes, np.int64)).any())
            for bits, hashes in zip(batch.column("bits").to_pylist(), batch.column("hashes").to_pylist())
        ]
        yield batch.filter(pa.array(hit, pa.bool_())).select(["batch_id", "bucket"])


class KeyStore:
    """The keys below one folder. A batch that is written again replaces what it wrote before."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def _hashed(self, rows: DataFrame) -> DataFrame:
        hashed = F.xxhash64(self.key)
        return rows.select(self.key, hashed.alias("hash"), bucket_of(hashed, self.buckets).alias("bucket"))

    def store(self, rows: DataFrame, batch_id: int) -> None:
        """Keep the keys of a batch. The filters are written last; a batch without them has not been stored."""
        own = f"{self.path}/keys/batch_id={batch_id}"
        keys = self._hashed(rows.filter(F.col(self.key).isNotNull())).dropDuplicates([self.key])
        keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(own)
        schema = T.StructType([keys.schema[self.key], T.StructField("hash", T.LongType()), T.StructField("bucket", T.IntegerType())])
        kept = self.spark.read.schema(schema).parquet(own)
        filters = kept.select("bucket", "hash").groupBy("bucket").applyInArrow(_filter, FILTERS)
        filters.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/filters/batch_id={batch_id}")

    def matching(self, rows: DataFrame, before: int) -> list[tuple[int, int]]:
        """(batch, bucket) of the earlier folders that may hold a key of `rows`: names of folders, whatever their size."""
        try:
            filters = self.spark.read.schema(f"{FILTERS}, batch_id long").parquet(f"{self.path}/filters").filter(F.col("batch_id") < before)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        incoming = self._hashed(rows).select("bucket", "hash").distinct().groupBy("bucket").applyInArrow(_packed, "bucket int, hashes binary")
        met = filters.join(incoming, "bucket").select("batch_id", "bucket", "bits", "hashes")
        found = met.mapInArrow(_tested, "batch_id long, bucket int")
        return sorted((r["batch_id"], r["bucket"]) for r in found.collect())

    def unseen(self, rows: DataFrame, before: int) -> DataFrame:
        """The rows whose key no batch before `before` has."""
        folders = [f"{self.path}/keys/batch_id={b}/bucket={k}" for b, k in self.matching(rows, before)]
        if not folders:
            return rows
        schema = T.StructType([T.StructField(self.key, rows.schema[self.key].dataType)])
        return rows.join(self.spark.read.schema(schema).parquet(*folders), self.key, "left_anti")
