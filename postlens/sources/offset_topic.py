"""A topic of landed messages: partitions with offsets, in files that a stream can be started in anywhere.

A topic is a folder of Parquet files below `partition=<n>`, each with consecutive offsets.
The reader takes the range of each file from its footer and hands out (partition, from, to)
to the tasks, which read the files that overlap it, so a batch costs what it holds and not
what the topic holds. A file that shows up before the ones below it is left for later:
a partition is read as far as its offsets go without a gap.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

# The classes travel to the workers by value: they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "offset_topic"
SCHEMA = "value string, partition int, offset long"
EARLIEST, LATEST = -2, -1
FILE_MESSAGES = 1_000_000
# What a task reads and hands on at once.
BUFFER = 1 << 20
BATCH_MESSAGES = 256
BATCH_BYTES = 1 << 22


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":" in path else (pafs.LocalFileSystem(), path)


class Footers:
    """The files of a topic and their ranges of offsets; a footer is read once."""

    def __init__(self, path: str):
        self.path = path
        self.known: dict[str, tuple[int, int]] = {}

    def files(self) -> dict[int, list[tuple[int, int, str]]]:
        """partition -> (first offset, end, path) in order, as far as there is no gap."""
        system, root = _filesystem(self.path)
        found: dict[int, list[tuple[int, int, str]]] = {}
        for info in system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True)):
            folder = info.path.removeprefix(root).strip("/").split("/")
            if len(folder) != 2 or not folder[0].startswith("partition=") or folder[1][0] in "._" or not info.is_file:
                continue
            if info.path not in self.known:
                self.known[info.path] = self._range(system, info.path)
            first, end = self.known[info.path]
            if end > first:
                found.setdefault(int(folder[0].removeprefix("partition=")), []).append((first, end, info.path))
        whole = {}
        for partition, files in found.items():
            files.sort()
            whole[partition] = [f for i, f in enumerate(files) if all(files[k][1] == files[k + 1][0] for k in range(i))]
        return whole

    @staticmethod
    def _range(system: pafs.FileSystem, path: str) -> tuple[int, int]:
        with system.open_input_file(path) as file:
            footer = pq.ParquetFile(file).metadata
        at = footer.schema.names.index("offset")
        bounds = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        return (min(b.min for b in bounds), max(b.max for b in bounds) + 1) if bounds else (0, 0)


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


@dataclass
class Slice(InputPartition):
    partition: int
    first: int
    end: int
    files: list[str]


class TopicReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str):
        self.path, self.starting = path, starting
        self.footers = Footers(path)

    def initialOffset(self) -> dict:
        """Where a stream without a checkpoint starts, by partition; one that comes later starts at its earliest offset."""
        ends = {p: (files[0][0], files[-1][1]) for p, files in self.footers.files().items()}
        if self.starting in ("earliest", "latest"):
            return {str(p): e[self.starting == "latest"] for p, e in ends.items()}
        asked = {int(p): int(o) for p, o in json.loads(self.starting).items()}
        out = {}
        for p, (first, end) in ends.items():
            wanted = asked.get(p, EARLIEST)
            # An offset outside of what is there means the nearest one that is.
            out[str(p)] = first if wanted == EARLIEST else end if wanted == LATEST else min(max(wanted, first), end)
        return out

    def latestOffset(self) -> dict:
        return {str(p): files[-1][1] for p, files in self.footers.files().items()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A slice for each file that has messages between the two."""
        files = self.footers.files()
        out: list[InputPartition] = []
        for p, upto in sorted(end.items()):
            held = files.get(int(p), [])
            since = start.get(p, held[0][0] if held else upto)
            out += [Slice(int(p), max(since, a), min(upto, b), [path]) for a, b, path in held if a < upto and b > since]
            if since < upto and (not held or held[0][0] > since or held[-1][1] < upto):
                raise ValueError(f"partition {p} of {self.path} no longer has offsets {since} to {upto}")
        return out

    def read(self, part: InputPartition) -> Iterator[pa.RecordBatch]:
        """The messages of a slice, a page of the file at a time: a task never holds the file, nor a row group of it."""
        system, _ = _filesystem(self.path)
        for path in part.files:
            with system.open_input_file(path) as file:
                messages = pq.ParquetFile(file, buffer_size=BUFFER, pre_buffer=False)
                footer = messages.metadata
                at = footer.schema.names.index("offset")
                bounds = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
                groups = [g for g, b in enumerate(bounds) if b.max >= part.first and b.min < part.end]
                batches = messages.iter_batches(BATCH_MESSAGES, row_groups=groups, columns=["value", "offset"], use_threads=False) if groups else ()
                for batch in batches:
                    wanted = pc.and_(pc.greater_equal(batch["offset"], part.first), pc.less(batch["offset"], part.end))
                    kept = batch.filter(wanted)
                    for start, end in packs(pc.binary_length(kept["value"]).fill_null(0).to_pylist(), BATCH_BYTES):
                        rows = kept.slice(start, end - start)
                        yield pa.RecordBatch.from_arrays(
                            [rows["value"].cast(pa.string()), pa.array([part.partition] * len(rows), pa.int32()), rows["offset"]],
                            ["value", "partition", "offset"],
                        )
        pa.default_memory_pool().release_unused()


class OffsetTopic(DataSource):
    """`spark.readStream.format("offset_topic").option("startingOffsets", ...).load(path)`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return TopicReader(self.options["path"], self.options.get("startingOffsets", "latest"))


def checked_offsets(starting: str) -> str:
    """`earliest`, `latest`, or JSON of partition -> offset (-2 earliest, -1 latest), as a topic of a broker takes them."""
    if starting in ("earliest", "latest"):
        return starting
    try:
        said = json.loads(starting)
        if not all(int(p) >= 0 and int(o) >= EARLIEST for p, o in said.items()):
            raise ValueError("negative")
    except (ValueError, AttributeError, TypeError) as wrong:
        raise ValueError(f"offsets are earliest, latest or JSON of partition and offset, not {starting!r}") from wrong
    return starting


def register(spark: SparkSession) -> None:
    spark.dataSource.register(OffsetTopic)


def land(messages: DataFrame, path: str, partition: Column, *order: str, value: str = "value") -> None:
    """Append messages to a topic, which is made if it is not there.

    Within a partition offsets go on from the last one in the order of the given columns.
    One writer at a time. What a partition gets at once is numbered by one task, as in any log;
    the number of partitions is what spreads a landing.
    """
    ends = {p: files[-1][1] for p, files in Footers(path).files().items()}
    base = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ends.items() for x in kv]), F.col("partition")), F.lit(0)) if ends else F.lit(0)
    numbered = messages.withColumn("partition", partition.cast("int"))
    place = F.row_number().over(Window.partitionBy("partition").orderBy(*order)) - 1
    rows = numbered.withColumn("offset", (place + base).cast("long")).select(F.col(value).alias("value"), "offset", "partition")
    rows.write.mode("append").option("maxRecordsPerFile", FILE_MESSAGES).partitionBy("partition").parquet(path)
