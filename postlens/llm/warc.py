r"""WARC archives: writing page records, and reading them back by boundary-chain verification.

Writing: every page becomes one record, written by Spark's text writer with the record
end as line separator, so each task writes one archive. Pages with equal payloads (by
SHA-256 and length) revisit the one with the smallest id. The table of revisits is
written first; Spark's size check decides whether it is sent to all tasks or the pages
are shuffled to it.

Reading: archives are read as lines that end at the record magic, so that one large
file is read by many tasks. Every magic is a candidate record; its header gives the
offset of its successor. Offsets are sums of line lengths over the blocks of a file.
Pointer jumping from the start of each file then doubles, round by round, the part of
the chain that is known, and only candidates on the chain are records: a magic inside a
payload is on none. A record whose payload holds a magic is put together from its
lines by a second look at the archive, which only happens if there is one: the lines of
such archives are written with the offsets that this look itself gives, as it may cut
files into other blocks than the first. A cut-off last record is left out; a complete
one whose payload cannot be put together is an error.

Edge cases: a null payload is empty, a null URL too; control characters and spaces of a URL are
percent-encoded. A null id comes after all others: among equal payloads without any id
all are responses, as are rows that repeat the smallest id. Only id, URL and payload
are read. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm.common import payload, saved
from postlens.session import new_path

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: both digit orders
LINE_SCHEMA = (
    "file string, block long, seq long, size long, head long, length long, kind string, page_id string, "
    "refers_to string, whole boolean, payload_bytes long, payload_digest string"
)


def digest(data: Column) -> Column:
    """Bare upper-case base32 SHA-1; ten hex digits are eight base32 digits."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _record_id(page_id: Column) -> Column:
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("null"))).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _encoded_url(url: Column) -> Column:
    """Control characters and spaces as percent codes; most URLs have none."""
    raw = F.coalesce(url, F.lit(""))
    out = raw
    for code in [*range(33), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(raw.rlike(r"[\x00-\x20\x7F]"), out).otherwise(raw)


def revisits(pages: DataFrame, id_col: str, min_bytes: int) -> DataFrame:
    """(page_id, sha, first): pages whose payload an earlier page has."""
    found = pages.select(F.col(id_col).alias("page_id"), F.sha2("payload", 256).alias("sha"), F.octet_length("payload").alias("n"))
    found = found.filter(F.col("n") >= min_bytes)
    groups = found.groupBy("sha", "n").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    many = groups.filter("rows > 1 AND first IS NOT NULL").select("sha", "n", "first")
    later = found.join(many, ["sha", "n"]).filter("page_id IS NULL OR page_id > first")
    return saved(later.select("page_id", "sha", "first").distinct(), "revisits")


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0
) -> None:
    """One record per page, in as many archives as the input has tasks."""
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload(payload_col).alias("payload")
    )
    known = revisits(rows, "page_id", min_bytes).select(
        F.col("page_id").alias("_id"), F.col("sha").alias("_sha"), F.col("first").alias("_first")
    )
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.sha2("payload", 256) == F.col("_sha"))
    typed = rows.join(known, same, "left")
    again = F.col("_first").isNotNull()
    block = F.when(again, F.lit(HTTP.encode())).otherwise(F.concat(F.lit(HTTP.encode()), F.col("payload")))
    fields = F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        F.when(again, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "),
        _record_id(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        _encoded_url(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        digest(F.col("payload")),
        F.lit("\r\nX-Page-Id: "),
        F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.when(
            again,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "),
                _record_id(F.col("_first")),
                F.lit("\r\nX-Refers-To-Page: "),
                F.col("_first").cast("string"),
            ),
        ).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
    )
    record = F.concat(fields.cast("binary"), block).cast("string")
    typed.select(record.alias("value")).write.option("lineSep", END).text(path)


def _header(line: bytes) -> tuple[int, dict[str, str]]:
    """Length of the header with its empty line, and its fields; 0 if it is none."""
    end = line.find(b"\r\n\r\n")
    if end < 0:
        return 0, {}
    fields = {}
    for one in line[:end].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = one.partition(":")
        if not colon:
            return 0, {}
        fields[name.strip().lower()] = value.strip()
    length = fields.get("content-length", "")
    return (end + 4, fields) if length.isascii() and length.isdigit() and len(length) < 16 else (0, {})


def _payload(block: bytes, fields: dict[str, str]) -> bytes:
    """What follows the HTTP header, or the whole block of a record without one."""
    if fields.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(line: bytes, head: int, fields: dict[str, str]) -> tuple[int, str]:
    data = _payload(line[head : head + int(fields["content-length"])], fields)
    return len(data), _sha1(data)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], bytes]]:
    """Each line with its file, block, and number within the block."""
    seen: tuple | None = None
    seq = 0
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        for file, block, value in zip(files, blocks, batch.column("value")):
            if (file, block) != seen:
                seen, seq = (file, block), 0
            yield (file, block, seq), value.as_py()
            seq += 1


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in LINE_SCHEMA.split(", ")]
    kinds = [pa.string(), *[pa.int64()] * 5, *[pa.string()] * 3, pa.bool_(), pa.int64(), pa.string()]
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for at, line in _numbered(batches):
        head, fields = _header(line)
        length = int(fields["content-length"]) if head else None
        whole = bool(head) and len(line) == head + length + len(END) and line.endswith(END.encode())
        size, sha = _record(line, head, fields) if whole else (None, None)
        said = [fields.get(f) or None for f in ("warc-type", "x-page-id", "x-refers-to-page")]
        rows.append((*at, len(line) + len(MAGIC), head or None, length, *said, whole, size, sha))
        if len(rows) == 5000:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def _raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for at, line in _numbered(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (*at, len(line) + len(MAGIC), line)], ["file", "block", "seq", "size", "line"]
        )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", MAGIC).text(path)
    return read.select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every magic of every archive: its offset and, if a header follows, its successor's offset."""
    placed = _placed(saved(_lines(spark, path).mapInArrow(_described, LINE_SCHEMA), "lines"))
    return placed.withColumn("after", F.col("offset") + len(MAGIC) + F.col("head") + F.col("length") + len(END))


def _placed(lines: DataFrame) -> DataFrame:
    """The lines of one look at the archives, with their offsets and the ends of their files."""
    in_block = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("file", "block").agg(F.sum("size").alias("n"))
    end = F.sum("n").over(Window.partitionBy("file")) - len(MAGIC)
    starts = sizes.select("file", "block", F.coalesce(F.sum("n").over(in_file), F.lit(0)).alias("base"), end.alias("end"))
    placed = lines.withColumn("inner", F.coalesce(F.sum("size").over(in_block), F.lit(0))).join(starts, ["file", "block"])
    # A line starts after the magic that ended the line before it; the empty first line has none.
    offset = F.col("base") + F.col("inner") - len(MAGIC)
    return placed.withColumn("offset", offset).drop("base", "inner")


def chain(found: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that a file's first record leads to."""
    jump = saved(found.filter("after IS NOT NULL").select("file", "offset", "after"), "jumps")
    reached = found.filter("offset = 0").select("file", "offset")
    while not jump.isEmpty():
        step = reached.join(jump, ["file", "offset"]).select("file", F.col("after").alias("offset"))
        reached = saved(reached.unionByName(step).distinct(), "reached")
        onward = jump.select("file", F.col("offset").alias("after"), F.col("after").alias("further"))
        jump = saved(jump.join(onward, ["file", "after"]).select("file", "offset", F.col("further").alias("after")), "jumps")
    return reached


def _joined(spark: SparkSession, path: str, broken: DataFrame) -> DataFrame:
    """Payload size and digest of the records that span several lines."""
    raw = _lines(spark, path).mapInArrow(_raw, "file string, block long, seq long, size long, line binary")
    raw = saved(raw.join(broken.select("file").distinct(), "file", "left_semi"), "raw", batch_rows=1000)
    starts = broken.select("file", "offset", F.col("offset").alias("owner"), F.col("after").alias("until"))
    order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owned = _placed(raw.select("file", "block", "seq", "size")).join(starts, ["file", "offset"], "left")
    for column in ("owner", "until"):
        owned = owned.withColumn(column, F.last(column, ignorenulls=True).over(order))
    needed = owned.filter("offset < until").select("file", "block", "seq", "offset", "owner")
    pieces = raw.drop("size").join(needed, ["file", "block", "seq"]).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("offset", "line"))).alias("lines")
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, owner, lines in zip(*[batch.column(c) for c in ("file", "owner", "lines")]):
                text = MAGIC.encode().join(x["line"] for x in lines.as_py())
                head, fields = _header(text)
                whole = len(text) >= head + int(fields["content-length"]) + len(END)
                values = (file.as_py(), owner.as_py(), *(_record(text, head, fields) if whole else (None, None)))
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(values, kinds)], ["file", "offset", "whole_bytes", "whole_digest"]
                )

    return pieces.mapInArrow(measured, "file string, offset long, whole_bytes long, whole_digest string")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record."""
    try:
        found = saved(candidates(spark, path), "candidates")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    records = saved(found.join(chain(found), ["file", "offset"], "left_semi"), "records")
    broken = records.filter("NOT whole AND after IS NOT NULL")
    if not broken.isEmpty():
        joined = saved(_joined(spark, path, broken), "joined")
        lost = F.raise_error(F.concat(F.lit("no payload of the record at "), "offset", F.lit(" of "), "file")).cast("long")
        records = records.join(joined, ["file", "offset"], "left").withColumns(
            {
                "payload_bytes": F.coalesce("payload_bytes", "whole_bytes", F.when(F.col("after") <= F.col("end"), lost)),
                "payload_digest": F.coalesce("payload_digest", "whole_digest"),
            }
        )
    records = records.filter("payload_bytes IS NOT NULL").select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )
    first = records.filter("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").agg(F.lit(1))
    again = records.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to")
    resolved = again.join(first, "refers_to", "left")
    return records.filter("record_type <> 'revisit'").unionByName(resolved.select(*records.columns))


def round_trip(pages: DataFrame, min_bytes: int = 0, **columns: str) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write_archive(pages, path, min_bytes=min_bytes, **columns)
    return read_archive(pages.sparkSession, path)
