"""Word counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions import text as tx
from postlens.functions.labels import label_name

# Bytes of words that a task counts at once, and rows of counts that it passes on at once.
SLICE_BYTES = 1 << 25
COUNT_ROWS = 1 << 16


def explode_words(df: DataFrame, keys: Sequence[str] = ("label",), text: str = "text") -> DataFrame:
    """One row per token of the text."""
    return df.select(*keys, F.explode(tx.split_words(F.col(text))).alias("word"))


def explode_tokens(df: DataFrame, tokens: str, keys: Sequence[str] = (), out: str = "word", place: str | None = None) -> DataFrame:
    """One row per entry of a token array that feature stages computed, with its place in the array on demand.

    For a plain `explode` the optimizer adds a filter on the array's size, and with
    it one more run of every tokenizer stage for each use of its output; the outer
    form with the null rows dropped gives the same rows and runs the stages once.
    """
    entries = F.explode_outer(tokens).alias(out) if place is None else F.posexplode_outer(tokens).alias(place, out)
    return df.select(*keys, entries).filter(F.col(out).isNotNull())


def _slice_counts(n: int, rows: pa.Table, skip: int) -> Iterator[pa.RecordBatch]:
    """(gram, n) of the 1- to n-grams that end after the first `skip` words; a gram is told by numbers until it is counted."""
    place = rows.column("place").to_numpy()
    coded = rows.column("word").combine_chunks().dictionary_encode()
    codes, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    ends, ids, grams = np.arange(len(codes)), codes, names
    for size in range(1, n + 1):
        if size > 1:
            before = np.full(len(codes), -1)
            before[ends] = ids
            ends = ends[(ends >= size - 1) & (place[ends] >= size - 1)]
            pairs = pa.array(before[ends - 1] * len(names) + codes[ends]).dictionary_encode()
            first, last = np.divmod(pairs.dictionary.to_numpy(), max(len(names), 1))
            ids, grams = pairs.indices.to_numpy(), pc.binary_join_element_wise(grams.take(pa.array(first)), names.take(pa.array(last)), " ")
        counts = np.bincount(ids[ends >= skip], minlength=len(grams))
        whole = pa.RecordBatch.from_arrays([grams, pa.array(counts)], ["gram", "n"]).filter(pa.array(counts > 0))
        for start in range(0, whole.num_rows, COUNT_ROWS):
            yield whole.slice(start, COUNT_ROWS)


def _counted(n: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of every `limit` bytes of (place, word), which is all that is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, skip, size = [], 0, 0
        try:
            for batch in batches:
                held.append(batch)
                size += batch.nbytes
                if size >= limit:
                    rows = pa.Table.from_batches(held)
                    yield from _slice_counts(n, rows, skip)
                    # A text may go on: its next grams begin with the last words.
                    skip = min(n - 1, rows.num_rows)
                    held, size = rows.slice(rows.num_rows - skip).combine_chunks().to_batches(), 0
            if held:
                yield from _slice_counts(n, pa.Table.from_batches(held), skip)
        finally:
            pa.default_memory_pool().release_unused()

    return run


def gram_counts(df: DataFrame, tokens: str, n: int = 1, out: str = "gram") -> DataFrame:
    """(`out`, n): occurrences of each 1- to n-gram of a token array, words of a gram joined by a blank.

    Most grams are rare, so that a plain count of a map task holds nearly all of its grams,
    and sorts and spills them once they are too many. Here a map task counts slices of
    bounded size and passes the counts on; only the parts of the shuffle, whose number
    can grow with the input, are held whole.
    """
    placed = explode_tokens(df, tokens, place="place")
    sliced = placed.mapInArrow(_counted(n, SLICE_BYTES), "gram string, n bigint")
    return sliced.repartition("gram").groupBy(F.col("gram").alias(out)).agg(F.sum("n").alias("n"))


def filter_words(df: DataFrame, word: str = "word", pattern: str = tx.WORD_PATTERN) -> DataFrame:
    return df.filter(F.col(word).rlike(pattern))


def real_words(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """Replaces the text by the array of its real words, repeats kept; smaller to shuffle."""
    found = F.filter(tx.split_words(F.col(text)), lambda w: w.rlike(tx.WORD_PATTERN))
    return df.withColumn(out, found).drop(text)


def word_counts(df: DataFrame, keys: Sequence[str] = ("label",), text: str = "text", out: str = "freq") -> DataFrame:
    """Occurrences of each real word per key, unordered; counted in the map tasks first.

    Takes a text column, or the `words` that `real_words` made of it.
    """
    if "words" in df.columns:
        words = df.select(*keys, F.explode("words").alias("word"))
    else:
        words = filter_words(explode_words(df, keys, text))
    return words.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias(out))


def word_freq(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """Word counts per label, most frequent first.

    The word ends the sort key, so that the many words of equal count can be
    range-partitioned.
    """
    return word_counts(df, [label], text).orderBy(label, F.desc("freq"), "word")


def top_keywords(df: DataFrame, label: str = "label", text: str = "text", n: int = 20) -> DataFrame:
    """Words ranked by count within the label, rank <= n; ties share a rank and stay.

    Only distinct words reach the window, and each task passes on just its own
    ranks up to n.
    """
    by_count = Window.partitionBy(label).orderBy(F.desc("freq"))
    return (
        word_counts(df, [label], text)
        .withColumn("rank", F.rank().over(by_count))
        .filter(F.col("rank") <= n)
        .withColumn("category", label_name(F.col(label)))
    )
