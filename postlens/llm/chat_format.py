r"""Chat formatting with a prefix tree over conversations.

Each turn is written as `[INST]role[/INST]text</s>`. Control strings inside roles and
texts get a backslash after their first character, and backslashes are doubled, so the
format can be taken apart again. One token is one code point.

Conversations that start with the same turns share them. A turn's node is named by a
hash over all turns up to it. Distinct paths are sorted by these names, which is the
depth-first order of the tree, and dealt into packs by range; in a pack every node is
emitted once, with its place in the pack's sequence, its position id (the tokens of its
ancestors), the intervals of the sequence that it attends to (its ancestors, neighbours
merged), and its part under the loss mask, the assistant's text. Only the first path of
a pack repeats nodes that the pack before it has, too, so a first turn that very many
conversations share is spread over packs. Equal conversations are one path.

Edge cases: null roles and texts count as empty. Turns are ordered by turn, role and
text; a repeated turn is one more turn. Rows with a null conversation id form one
conversation. Other columns are not read. An empty table gives no rows. A task holds
one conversation at most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import saved

OPEN, CLOSE, STOP = "[INST]", "[/INST]", "</s>"
CONTROL = [OPEN, CLOSE, STOP, "<s>", "<<SYS>>", "<</SYS>>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)
ASSISTANT = "assistant"
NODE_SCHEMA = (
    "pack long, seq long, depth long, offset long, length long, position long, "
    "attends array<struct<start:long,end:long>>, loss_start long, loss_end long, piece string, leaf binary, turns long"
)
DIGEST_SCHEMA = (
    "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as formatted, and where the text stands in it."""
    head = OPEN + escape(role) + CLOSE
    body = escape(text)
    return head + body + STOP, len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    waiting: list[tuple] = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), schema)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns])


_NAMED = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("name", pa.binary()), ("role", pa.string()), ("text", pa.string()), ("path", pa.binary())]
)
NAMED_SCHEMA = "conv_id long, depth long, name binary, role string, text string, path binary"


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns with the names of their nodes, and after each conversation its path."""

    def rows() -> Iterator[tuple]:
        now: tuple | None = None
        names: list[bytes] = []
        for conv_id, _, role, text in _rows(batches):
            if now is None or now[0] != conv_id:
                if names:
                    yield now[0], len(names), names[-1], None, None, b"".join(names)
                now, names = (conv_id,), []
            h = hashlib.blake2b(names[-1] if names else b"", digest_size=16)
            r, t = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
            h.update(len(r).to_bytes(8, "big") + r + t)
            names.append(h.digest())
            yield conv_id, len(names) - 1, names[-1], role, text, None
        if names:
            yield now[0], len(names), names[-1], None, None, b"".join(names)

    yield from _batches(rows(), _NAMED)


_NODES = pa.schema(
    [(n, pa.int64()) for n in ("pack", "seq", "depth", "offset", "length", "position")]
    + [("attends", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
    + [("loss_start", pa.int64()), ("loss_end", pa.int64()), ("piece", pa.string()), ("leaf", pa.binary()), ("turns", pa.int64())]
)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes and conversation ends of each pack, depth first."""

    def rows() -> Iterator[tuple]:
        pack = seq = offset = None
        path: list[tuple[bytes, int, int, int, list]] = []  # name, offset, end, position, attends
        for at, _, depth, name, role, text, turns in _rows(batches):
            if at != pack:
                pack, seq, offset, path = at, 0, 0, []
            if depth == turns:  # the end of a conversation
                del path[depth:]
                yield pack, seq, depth, offset, 0, 0, [], 0, 0, None, name, turns
                seq += 1
                continue
            if depth < len(path) and path[depth][0] == name:
                continue
            del path[depth:]
            piece, start, end = format_turn(role, text)
            attends, position = [], 0
            if path:
                _, o, e, p, before = path[-1]
                position = p + e - o
                joins = before and before[-1][1] == o
                attends = [*before[:-1], (before[-1][0], e)] if joins else [*before, (o, e)]
            loss = (offset + start, offset + end) if role == ASSISTANT else (0, 0)
            listed = [{"start": a, "end": b} for a, b in attends]
            yield pack, seq, depth, offset, len(piece), position, listed, *loss, piece, None, None
            path.append((name, offset, offset + len(piece), position, attends))
            offset += len(piece)
            seq += 1

    yield from _batches(rows(), _NODES)


_DIGESTS = pa.schema(
    [("leaf", pa.binary()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each path's conversation, taken apart from the pieces on the way to its end."""

    def rows() -> Iterator[tuple]:
        path: list[tuple[str, int, int]] = []
        for depth, offset, start, end, piece, leaf in _rows(batches):
            del path[depth:]
            if piece is not None:
                path.append((piece, start - offset, end - offset))
                continue
            turns, loss = hashlib.sha256(), hashlib.sha256()
            count = chars = formatted = 0
            for one, a, b in path:
                for role, text in parse(one):
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                    count += 1
                masked = unescape(one[max(a, 0) : max(b, 0)])
                loss.update(masked.encode("utf-8", "surrogatepass"))
                chars += len(masked)
                formatted += len(one)
            yield leaf, count, turns.hexdigest(), chars, loss.hexdigest(), formatted

    yield from _batches(rows(), _DIGESTS)


def named_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Turns with node names, and a row with the path of each conversation."""
    rows = conversations.select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return saved(ordered.mapInArrow(_named, NAMED_SCHEMA), "turns")


def pack_conversations(named: DataFrame) -> DataFrame:
    """The packs: nodes in depth-first order, and an end row (no piece) for each path."""
    paths = named.filter("path IS NOT NULL").groupBy("name", "path").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("no_id"), F.col("conv_id"))).alias("first"),
        F.max("depth").alias("turns"),
    )
    # A number of its own: paths are small, and Spark would join them to packs far too large in text.
    packs = int(named.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = saved(
        paths.repartitionByRange(packs, "path")
        .sortWithinPartitions("path")
        .select(
            F.col("first.conv_id").alias("first"), "turns", F.spark_partition_id().cast("long").alias("pack"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "paths",
    )
    rows = named.join(ordered, F.col("conv_id").eqNullSafe(F.col("first")))
    laid = rows.select("pack", "place", "depth", "name", "role", "text", "turns")
    return laid.repartition(packs, "pack").sortWithinPartitions("pack", "place", "depth").mapInArrow(_packed, NODE_SCHEMA)


def digests(packs: DataFrame) -> DataFrame:
    """What the packs say about each path."""
    rows = packs.select("pack", "seq", "depth", "offset", "loss_start", "loss_end", "piece", "leaf")
    packs_at_once = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartition(packs_at_once, "pack").sortWithinPartitions("pack", "seq").drop("pack", "seq")
    return ordered.mapInArrow(_read_back, DIGEST_SCHEMA)


def format_conversations(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the packs."""
    named = named_turns(conversations, **columns)
    packs = saved(pack_conversations(named), "packs")
    of_path = saved(digests(packs), "digests")
    members = named.filter("path IS NOT NULL").select("conv_id", F.col("name").alias("leaf"))
    unique = of_path.groupBy(*of_path.columns).agg(F.lit(1)).select(*of_path.columns)
    return members.join(unique, "leaf").select("conv_id", *[c for c in of_path.columns if c != "leaf"])
