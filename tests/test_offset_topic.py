"""Landed messages read by partition and offset."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from postlens.sources import offset_topic, readers


@pytest.fixture
def topic(spark, tmp_path):
    path = str(tmp_path / "topic")

    def put(numbers, partitions=3):
        df = spark.createDataFrame([(n, f"m{n}") for n in numbers], "n long, value string")
        offset_topic.land(df, path, F.col("n") % partitions, "n")

    def read(offsets, name="out"):
        stream = readers.read_stream(spark, offset_topic.FORMAT, path=path, starting_offsets=offsets)
        out, checkpoint = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint")
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(out).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(offset_topic.SCHEMA).parquet(out).collect())

    return path, put, read


def expected(numbers, partitions=3):
    counts, out = {}, []
    for n in sorted(numbers):
        p = n % partitions
        out.append((f"m{n}", p, counts.get(p, 0)))
        counts[p] = out[-1][2] + 1
    return sorted(out)


def test_earliest_latest_and_explicit_offsets_give_different_rows(topic):
    _, put, read = topic
    put(range(20))
    every = expected(range(20))
    assert read("earliest", "a") == every
    assert read("latest", "b") == []
    assert read('{"0": 3, "1": -1, "2": 99}', "c") == [r for r in every if r[1] == 0 and r[2] >= 3]


def test_offsets_go_on_and_a_restart_reads_each_message_once(topic):
    path, put, read = topic
    put(range(9))
    first = read("earliest")
    put(range(9, 30))
    put(range(30, 40), partitions=5)  # two partitions that were not there
    again = read("latest")  # the checkpoint decides, not the option
    assert again == read("latest") and set(first) < set(again)
    assert len(again) == len(set(again)) == 40 and {r[0] for r in again} == {f"m{n}" for n in range(40)}
    assert len({r[1:] for r in again}) == 40
    assert read("latest", "late") == []


def test_a_batch_opens_only_files_with_its_offsets(topic):
    path, put, _ = topic
    for i in range(5):
        put(range(3 * i, 3 * i + 3))
    reader = offset_topic.TopicReader(path, "earliest")
    slices = reader.partitions({"0": 3, "1": 3, "2": 3}, {"0": 4, "1": 5, "2": 3})
    assert sorted((s.partition, s.first, s.end, len(s.files)) for s in slices) == [(0, 3, 4, 1), (1, 3, 4, 1), (1, 4, 5, 1)]
    with pytest.raises(ValueError):
        reader.partitions({"0": 3}, {"0": 9})


def test_a_gap_is_not_read_over(topic, tmp_path):
    path, put, read = topic
    for i in range(3):
        put([i], partitions=1)
    hidden = [f for first, _, f in offset_topic.Footers(path).files()[0] if first == 1]
    kept = tmp_path / "kept.parquet"
    file = tmp_path / "topic" / "partition=0" / hidden[0].rsplit("/", 1)[1]
    data = file.read_bytes()
    kept.write_bytes(data)
    file.rename(tmp_path / "moved")
    assert read("earliest") == [("m0", 0, 0)]
    file.write_bytes(data)
    assert read("earliest") == [(f"m{i}", 0, i) for i in range(3)]


def test_empty_topics_null_values_and_refused_options(spark, topic):
    path, put, read = topic
    assert read("earliest", "none") == []
    df = spark.createDataFrame([(0, None), (1, "")], "n long, value string")
    offset_topic.land(df, path, F.lit(0), "n")
    assert {(r[0], r[2]) for r in read_all(spark, path)} == {(None, 0), ("", 1)}
    for wrong in ("first", "[1]", '{"0": -3}', '{"x": 1}'):
        with pytest.raises(ValueError):
            offset_topic.checked_offsets(wrong)
    with pytest.raises(ValueError):
        readers.read_stream(spark, "text", path=path, starting_offsets="earliest")
    with pytest.raises(ValueError):
        readers.read_stream(spark, offset_topic.FORMAT, path=path, rate_limit=5)


def read_all(spark, path):
    reader = offset_topic.TopicReader(path, "earliest")
    return [(v, p, o) for s in reader.partitions(reader.initialOffset(), reader.latestOffset()) for b in reader.read(s) for v, p, o in zip(*b.to_pydict().values())]


def test_a_slice_is_read_in_small_batches_and_never_held_whole(tmp_path):
    """A file of 160 MB used to be read as one table, with all of its messages in memory."""
    (tmp_path / "topic" / "partition=0").mkdir(parents=True)
    path = str(tmp_path / "topic" / "partition=0" / "part.parquet")
    table = pa.table({"value": [f"{i:08d}" * 2_000 for i in range(10_000)], "offset": pa.array(range(10_000), pa.int64())})
    pq.write_table(table, path, row_group_size=1_000)
    size = table.nbytes
    del table
    reader = offset_topic.TopicReader(str(tmp_path / "topic"), "earliest")
    assert len(reader.partitions({}, {"0": 10_000})) == 1
    before, most, seen = pa.total_allocated_bytes(), 0, []
    for batch in reader.read(offset_topic.Slice(0, 7, 9_990, [path])):
        most = max(most, pa.total_allocated_bytes() - before)
        assert batch.column(0).nbytes < 2 * offset_topic.BATCH_BYTES
        seen += batch.column(2).to_pylist()
    assert seen == list(range(7, 9_990)) and most < size / 3


def test_explicit_offsets_are_checked_before_the_stream_starts(spark, topic):
    with pytest.raises((ValueError, PySparkException)):
        readers.read_stream(spark, offset_topic.FORMAT, path=topic[0], starting_offsets="yesterday")
