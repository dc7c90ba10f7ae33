"""Prefix trie over whole conversations, from their distinct sequences.

1. Every turn becomes a SHA-256 of role and text where it is read; texts are not shuffled.
   A conversation's turns, in order, give a chain of digests: the digest at depth d names
   the sequence of its first d turns. The chain is streamed over sorted rows, so a
   conversation of any length needs a constant amount of memory.
2. Identical conversations collapse to one weighted sequence: its weight, its least id
   (which names it from then on) and the list of the conversations that end there.
3. Sequences that are proper prefixes of others fall to an anti-join; the rest are leaves.
4. The prefixes of the weighted sequences, not of the conversations, are aggregated to nodes.

What a subtree saves is had without walking it. The tokens of its members are a weighted
sum over the sequences. The tokens of its distinct nodes are counted by ownership: the
least leaf below a node owns it, the nodes that a leaf owns are the end of its own path,
and a subtree consists of the ends of all its leaves' paths (its owner's cut at its top).
So both take one aggregation, whatever the depth.

The ends of a node are sorted by range over all tasks and joined to pieces of text; only
the pieces of one node meet, in order, in a running digest. A third of all conversations
in one group is therefore never one task's list.

Edge cases: null roles and texts are empty; rows without a conversation id take no part.
Turns come in the order of `turn`, nulls first, ties by the digest of role and text; equal
rows are turns of their own. A conversation without turns ends at the root. An empty table
gives no nodes, not even the root. Only the four named columns are read, so others cannot
clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from postlens.llm.common import lean, payload, saved

PIECE_IDS = 8192
ROOT = hashlib.sha256(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()
CHAIN = "conv_id long, depth long, node binary, parent binary, bytes long, upto long, last boolean"


def turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, place, digest, bytes) of every turn; place counts from 0 in each conversation."""
    role, text = payload(role_col), payload(text_col)
    name = F.concat(F.octet_length(role).cast("string").cast("binary"), F.lit(b":"), role, text)
    rows = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.unhex(F.sha2(name, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("place"), "digest", "bytes")


def with_shared_heads(rows: DataFrame, head_of: Column, length: Column, longest: int) -> DataFrame:
    """Every conversation's first `length` turns replaced by those of conversation `head_of`.

    Both columns are expressions over `conv_id`; no length is over `longest`. A head with
    fewer turns gives all it has, an absent one none; the conversation's own turns after
    its first `length` follow. A conversation that is left without turns keeps its row in
    `place` -1, as all have.
    """
    known = rows.filter("place = 0").select("conv_id", head_of.alias("head"), length.alias("length"))
    # A long conversation sends its first few turns only.
    heads = rows.filter(F.col("place") < longest).select(F.col("conv_id").alias("head"), "place", "digest", "bytes")
    shared = known.join(heads, "head").filter("place < length")
    own = rows.withColumn("length", length).filter("place >= length")
    return (
        shared.select("conv_id", F.lit(0).alias("part"), "place", "digest", "bytes")
        .unionByName(own.select("conv_id", F.lit(1).alias("part"), "place", "digest", "bytes"))
        .unionByName(_starts(known))
    )


def as_they_are(rows: DataFrame) -> DataFrame:
    """The turns of `turns` in the form that `chains` takes."""
    own = rows.select("conv_id", F.lit(1).alias("part"), "place", "digest", "bytes")
    return own.unionByName(_starts(rows.filter("place = 0")))


def _starts(known: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("binary")
    return known.select(
        "conv_id", F.lit(-1).alias("part"), F.lit(-1).cast("long").alias("place"), nothing.alias("digest"), F.lit(0).cast("long").alias("bytes")
    )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place: the digest of everything up to each row."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("bytes", pa.int64()), ("upto", pa.int64()), ("last", pa.bool_())]
    )
    held: list[tuple] = []  # at most one row, of which it is not known whether it is the last
    for batch in batches:
        out = held
        cols = (batch.column(c).to_pylist() for c in ("conv_id", "part", "digest", "bytes"))
        for conv, part, digest, size in zip(*cols):
            if part < 0:
                if out:
                    out[-1] = (*out[-1][:6], True)
                out.append((conv, 0, ROOT, None, 0, 0, False))
            else:
                _, depth, node, _, _, upto, _ = out[-1]
                out.append((conv, depth + 1, hashlib.sha256(node + digest).digest(), node, size, upto + size, False))
        held = out[-1:]
        if len(out) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[:-1]), schema)], schema=schema)
    if held:
        held = [(*held[0][:6], True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def chains(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, bytes, upto, last) for each prefix of each conversation, the empty one too.

    `node` and `parent` are digests, `bytes` those of the last text and `upto` those of all texts.
    """
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return saved(ordered.mapInArrow(lean(_chain), CHAIN), "trie-chains")


def sequences(chained: DataFrame) -> DataFrame:
    """(node, seq, weight, total, leaf): the distinct whole conversations.

    `seq` is the least id of the `weight` conversations that are equal, `total` their bytes
    each, `leaf` tells that no other conversation continues it.
    """
    whole = chained.filter("last").groupBy("node").agg(
        F.min("conv_id").alias("seq"), F.count(F.lit(1)).alias("weight"), F.min("upto").alias("total")
    )
    whole = saved(whole, "trie-sequences")
    continued = _of_sequences(chained, whole).filter("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = whole.join(continued, "node", "left_anti").select("seq", F.lit(True).alias("leaf"))
    flagged = whole.join(leaves, "seq", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
    return saved(flagged, "trie-sequences")


def _of_sequences(chained: DataFrame, whole: DataFrame) -> DataFrame:
    """The prefixes of one conversation of each sequence."""
    names = whole.select(F.col("seq").alias("conv_id"), *[c for c in whole.columns if c not in ("node", "seq")])
    return chained.join(names, "conv_id").withColumnRenamed("conv_id", "seq")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (node, conv_id) to (node, least id, ids joined by commas), some thousand ids at once."""
    now, ids = None, []
    for batch in batches:
        out: list[tuple] = []
        for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (node != now or len(ids) >= PIECE_IDS):
                out.append((now, ids[0], ",".join(map(str, ids))))
                ids = []
            now = node
            ids.append(conv)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["node", "first_id", "piece"])
    if ids:
        yield pa.RecordBatch.from_arrays(
            [pa.array([now], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "first_id", "piece"]
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to the digest of each node's whole list."""
    now, running = None, None
    for batch in batches:
        out: list[tuple] = []
        for node, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
            if node == now:
                running.update(b"," + piece.encode())
            else:
                if running:
                    out.append((now, running.hexdigest()))
                now, running = node, hashlib.sha256(piece.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.string()))], ["node", "ends_sha256"])
    if running:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])], ["node", "ends_sha256"])


def end_lists(chained: DataFrame) -> DataFrame:
    """(node, first_id, piece): the ids of the conversations that end at a node, ascending over its pieces."""
    ends = chained.filter("last").select("node", "conv_id")
    ordered = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    return saved(ordered.mapInArrow(lean(_pieces), "node binary, first_id long, piece string"), "trie-ends")


def trie(chained: DataFrame) -> DataFrame:
    """One row per node: its least member and depth, its parent's, members, children, leaves, savings, ends."""
    whole = sequences(chained)
    prefixes = _of_sequences(chained, whole)
    nodes = prefixes.groupBy("node").agg(
        F.min("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.min("seq").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count_if("leaf").alias("n_leaves"),
        F.min(F.when(F.col("leaf"), F.col("seq"))).alias("owner"),
        F.min(F.col("upto") - F.col("bytes")).alias("before"),
        F.sum(F.col("weight") * F.col("total")).alias("member_bytes"),
    )
    nodes = saved(nodes, "trie-nodes")
    # What a leaf owns starts at the highest node of which it is the least leaf.
    owned = nodes.groupBy(F.col("owner").alias("seq")).agg(F.min_by("before", "depth").alias("shared"))
    leaf_prefixes = prefixes.filter("leaf").select("seq", "node", "total").join(owned, "seq")
    below = leaf_prefixes.groupBy("node").agg(
        F.sum(F.col("total") - F.col("shared")).alias("own_ends"), F.min_by("shared", "seq").alias("shared")
    )
    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = end_lists(chained).repartition("node").sortWithinPartitions("node", "first_id")
    digests = ends.mapInArrow(lean(_digests), "node binary, ends_sha256 string")
    # The owner's path counts from this node on, not from where it begins to own.
    distinct = F.col("own_ends") + F.col("shared") - F.col("before")
    return (
        nodes.join(below, "node")
        .join(children, "node", "left")
        .join(digests, "node", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
            (F.col("member_bytes") - F.col("n_convs") * F.col("before") - distinct).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
