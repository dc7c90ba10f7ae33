"""SimHash fingerprints, and search within a Hamming radius by permuted block tables.

Every word votes on 64 signed bits with its hash, weighted by the square of its length
(at most 12), so that long words count for more than the common short ones. Votes are
summed as two 32-bit lanes in each of 32 numbers, inside generated code, and combined
in the map task that holds the document: only 32 numbers per text are shuffled.

A search cuts the 64 bits into blocks. If two fingerprints differ in at most r bits,
b - r of b blocks agree; for every choice of b - r blocks there is a table keyed by
them, and candidates from the tables are compared in full. Tables hold each different
fingerprint once, with its number of documents, so a large group of copies is one row.
`near_copies` gives the fingerprints found for each query row, and the rows of each
fingerprint: together they name every near copy, without a row for each pair of rows.

`edited` builds the text with its end replaced from the next document. Ids are cut into
ranges of about equal counts; the texts are shuffled once by range, and the first row of
every range is also sent to the range before it.

Edge cases: a null text counts as empty; a text without words has the fingerprint 0.
Rows are ordered by id and then by a hash of the text; a null id has no place in the
order, and such a row is its own next one. One row alone is its own next one, too. Other columns are
not read. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import saved

BITS = 64
LANE_MASK = 0x0000000100000001
MAX_RANGES = 1 << 16
LONGEST = 12
_GAP = r"[\x20\x09-\x0D]+"


def votes(texts: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """One fingerprint (a long) for each row of `texts`; `keys` tell the rows apart."""
    words = texts.select(*keys, F.explode(F.split(F.col(text_col), _GAP)).alias("word"))
    length = F.least(F.char_length("word"), F.lit(LONGEST))
    hashed = words.select(*keys, F.xxhash64("word").alias("_vote"), (length * length).cast("long").alias("_weight"))
    lanes = [
        F.sum(F.shiftright("_vote", k).bitwiseAND(F.lit(LANE_MASK)) * F.col("_weight")).alias(f"v{k}") for k in range(BITS // 2)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("_weight").alias("all"), *lanes)
    low = F.lit((1 << 32) - 1)
    bits: Column = F.lit(0).cast("long")
    for k in range(BITS // 2):
        for bit, lane in ((k, F.col(f"v{k}").bitwiseAND(low)), (k + 32, F.shiftrightunsigned(F.col(f"v{k}"), 32))):
            on = F.when(lane * 2 > F.col("all"), F.lit(1 << bit if bit < 63 else -(1 << 63)).cast("long"))
            bits = bits.bitwiseOR(F.coalesce(on, F.lit(0).cast("long")))
    return summed.select(*keys, bits.alias("bits"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), BITS // 4, "0")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, text, next_id, next_h, next_text): every row beside its successor by id."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    ).withColumn("h", F.xxhash64("text"))
    lone = rows.filter("doc_id IS NULL").select(
        "doc_id", "h", "text", F.col("doc_id").alias("next_id"), F.col("h").alias("next_h"), F.col("text").alias("next_text")
    )
    placed = rows.filter("doc_id IS NOT NULL").withColumn("_at", F.col("doc_id").cast("double"))
    ranges = min(MAX_RANGES, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = docs.select(F.col(f"`{id_col}`").cast("double").alias("_at")).filter("_at IS NOT NULL")
    bounds = ids.approxQuantile("_at", [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    if not bounds:
        return lone
    splits = [-float("inf"), *sorted(set(bounds)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_at", outputCol="_range")
    firsts = cut.transform(ids).groupBy("_range").agg(F.min("_at").alias("first")).orderBy("_range").collect()
    before = F.create_map(
        *[F.lit(x) for i, r in enumerate(firsts) for x in (r["_range"], firsts[i - 1]["_range"])]
    )
    ranged = cut.transform(placed).withColumn("_late", F.lit(0))
    sent = ranged.filter(F.col("_at").isin([r["first"] for r in firsts])).select(
        "doc_id", "text", "h", "_at", F.try_element_at(before, F.col("_range")).alias("_range"), F.lit(1).alias("_late")
    )
    order = Window.partitionBy("_range").orderBy("_late", "doc_id", "h")
    nexts = [F.lead(c).over(order).alias(f"next_{n}") for c, n in (("doc_id", "id"), ("h", "h"), ("text", "text"))]
    both = ranged.unionByName(sent).select("doc_id", "h", "text", "_late", *nexts)
    return both.filter("_late = 0").drop("_late").unionByName(lone)


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its length and its text's last quarter replaced from the next document."""
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    quarter = F.expr("CAST(n_chars div 4 AS INT)")
    text = F.concat(F.expr("left(text, CAST(n_chars - n_chars div 4 AS INT))"), F.left("next_text", quarter))
    return rows.select("doc_id", "h", "n_chars", "next_id", "next_h", "text", text.alias("edited"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h, n_chars, edited_sha256, bits, edited_bits, next_id and next_h of every row."""
    keys = ["row", "doc_id", "h", "n_chars", "next_id", "next_h", "edited_sha256"]
    rows = edited(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    both = rows.select(
        *keys[:-1],
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.explode(F.array(F.struct(F.lit(0).alias("v"), "text"), F.struct(F.lit(1).alias("v"), F.col("edited").alias("text")))).alias("one"),
    ).select(*keys, "one.v", "one.text")
    voted = votes(both, [*keys, "v"], "text")
    wide = voted.groupBy(*keys).agg(
        F.max(F.when(F.col("v") == 0, F.col("bits"))).alias("bits"),
        F.max(F.when(F.col("v") == 1, F.col("bits"))).alias("edited_bits"),
    )
    return saved(wide, "fingerprints")


def near_pairs(found: DataFrame, queries: Column, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(bits, near_bits, n): for each fingerprint of a query row, those within `radius` bits, itself included, and their rows."""
    counted = found.groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    asked = found.filter(queries).select(F.col("bits").alias("q")).distinct()
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - radius):
        mask = sum(((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)

    def table(df: DataFrame, column: str) -> DataFrame:
        keyed = [F.struct(F.lit(i).alias("t"), F.col(column).bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
        return df.select("*", F.explode(F.array(*keyed)).alias("at")).select(*df.columns, "at.t", "at.key")

    pairs = table(asked, "q").join(table(counted, "bits"), ["t", "key"])
    close = pairs.filter(F.bit_count(F.col("q").bitwiseXOR(F.col("bits"))) <= radius)
    # A pair can meet in several tables: each pair counts once.
    return close.groupBy(F.col("q").alias("bits"), F.col("bits").alias("near_bits")).agg(F.max("n").alias("n"))


def near_counts(found: DataFrame, queries: Column, radius: int = 3, blocks: int = 5) -> DataFrame:
    """(bits, n_near): for each fingerprint of a query row, the rows within `radius` bits, itself included."""
    return near_pairs(found, queries, radius, blocks).groupBy("bits").agg(F.sum("n").alias("n_near"))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, query_step: int = 100
) -> tuple[DataFrame, DataFrame]:
    """What the search finds for the rows whose id is divisible by `query_step`, as (doc_id, fingerprint,
    near_fingerprint, distance), and (fingerprint, doc_id) of all rows.

    Rows that repeat an id and a fingerprint are found once.
    """
    texts = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    ).withColumn("row", F.monotonically_increasing_id())
    found = saved(votes(texts, ["row", "doc_id"], "text").drop("row"), "fingerprints")
    asked = F.col("doc_id") % query_step == 0
    pairs = found.filter(asked).distinct().join(near_pairs(found, asked, radius), "bits").select(
        "doc_id",
        as_text(F.col("bits")).alias("fingerprint"),
        as_text(F.col("near_bits")).alias("near_fingerprint"),
        F.bit_count(F.col("bits").bitwiseXOR(F.col("near_bits"))).alias("distance"),
    )
    return pairs, found.select(as_text(F.col("bits")).alias("fingerprint"), "doc_id")


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, query_step: int = 100) -> DataFrame:
    """Fingerprints of all texts and edited texts, and how alike they are.

    `n_near`, for rows whose id is divisible by `query_step`, counts the rows of the whole
    table whose fingerprints differ in at most `radius` bits.
    """
    found = fingerprints(docs, id_col, text_col)
    lookup = found.groupBy(F.col("doc_id").alias("next_id"), F.col("h").alias("next_h")).agg(F.max("bits").alias("next_bits"))
    nexts = found.filter("doc_id IS NOT NULL").join(lookup, ["next_id", "next_h"])
    whole = nexts.unionByName(found.filter("doc_id IS NULL").withColumn("next_bits", F.col("bits")))
    asked = F.col("doc_id") % query_step == 0
    near = near_counts(found, asked, radius)
    return whole.join(near, "bits", "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("bits")).alias("fingerprint"),
        as_text(F.col("edited_bits")).alias("edited_fingerprint"),
        likeness(F.col("bits"), F.col("edited_bits")).alias("near_edited"),
        likeness(F.col("bits"), F.col("next_bits")).alias("near_next"),
        F.when(asked, F.col("n_near")).alias("n_near"),
    )
