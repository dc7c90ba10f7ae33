"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts the n-grams (1 to 3 code points of the lower-case text) of a sample of
labelled rows per language in a fixed number of hash buckets. The log-probability
matrix has buckets x languages entries and is broadcast; to bound it, at most the
`MAX_LANGUAGES` most frequent languages of the usable rows are learned (ties by name).
A task that has the counts of one language makes its column of the matrix, so the
driver gets one array per language. Scoring
gathers its rows for all n-grams of a pack of texts at once and adds them up by text.

Edge cases: a null text or one without a letter gets `und` and score 0, as does every
text if nothing could be learned (no labelled rows). Letters are the Unicode categories L,
so a fraction or a circled digit is none. Null languages are never learned.
Input columns named like an output column are replaced. Long texts are scored in
segments that overlap by two code points, and never cut short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import lean, packs, smaller

BUCKET_BITS = 16
MAX_LANGUAGES = 512
SEGMENT = 1 << 19
TEXT_BYTES = 1 << 21
LANGUAGES_AT_ONCE = 64
UNDETERMINED = "und"
_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages


def _segments(texts: Iterable[str]) -> Iterator[tuple[int, str, int]]:
    """(number of the text, segment, number of its places where n-grams start)."""
    for i, text in enumerate(texts):
        lowered = f" {text.lower()} "
        for at in range(0, max(1, len(lowered) - 2), SEGMENT):
            part = lowered[at : at + SEGMENT + 2]
            yield i, part, len(part) if at + SEGMENT + 2 >= len(lowered) else SEGMENT


def _ngrams(segments: list[str], starts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket of every n-gram and the segment it starts in, in order."""
    points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(s) for s in segments])
    owner = np.repeat(np.arange(len(segments)), size)
    own = np.arange(len(points)) - np.repeat(np.cumsum(size) - size, size) < np.repeat(starts, size)
    code = np.zeros(len(points), np.uint64)
    for n, factor in enumerate(_FACTORS):
        size = len(points) - n
        if size <= 0:
            return
        code = code[:size] + (points[n:] + np.uint64(1)) * factor
        inside = (owner[:size] == owner[n:]) & own[:size]
        spread = code * np.uint64(0xD6E8FEB86659FD93)
        yield (spread[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), owner[:size][inside]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[int, np.ndarray] = {}
    for batch in smaller(batches, "text", TEXT_BYTES):
        texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        langs = batch.column("lang").to_pylist()
        cut = list(_segments(texts))
        for a, b in packs([len(s) for _, s, _ in cut], SEGMENT):
            owners = np.array([langs[i] for i, _, _ in cut[a:b]])
            for buckets, owner in _ngrams(*map(list, list(zip(*cut[a:b]))[1:])):
                for lang in set(owners.tolist()):
                    total = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                    total += np.bincount(buckets[owners[owner] == lang], minlength=1 << BUCKET_BITS)
        if len(counts) > LANGUAGES_AT_ONCE:
            yield from _emptied(counts)
    yield from _emptied(counts)


def _emptied(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    while counts:
        lang, total = counts.popitem()
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(used), lang)), pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["lang", "bucket", "n"]
        )


def _column(smoothing: float) -> Callable:
    """The log-probabilities of all buckets from the counts of one language."""

    def column(key: tuple, table: pa.Table) -> pa.Table:
        counts = np.full(1 << BUCKET_BITS, smoothing)
        counts[table.column("bucket").to_numpy()] += table.column("n").to_numpy()
        return pa.table({"lang": [key[0].as_py()], "log_prob": [np.log(counts / counts.sum()).astype("<f4").tobytes()]})

    return column


def train(
    docs: DataFrame,
    usable: Column,
    key: Column,
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = 4000,
    smoothing: float = 0.1,
) -> Model:
    """Fit on about `sample_per_language` of the usable rows of every language, whole texts.

    `key` is hashed to draw the sample, so a repeated run draws the same rows. The
    priors are the shares of the languages among all usable rows.
    """
    rows = docs.filter(usable & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")).alias("text"),
        (F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))).alias("draw"),
    )
    frequent = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    totals = {r["lang"]: r["n"] for r in frequent.collect()}
    languages = sorted(totals)
    if not languages:
        return Model([], np.zeros(0), np.zeros((1 << BUCKET_BITS, 0), np.float32))
    codes = F.create_map(*[F.lit(x) for code, lang in enumerate(languages) for x in (lang, code)])
    rates = F.array(*[F.lit(sample_per_language / totals[lang]) for lang in languages])
    coded = rows.withColumn("lang", F.try_element_at(codes, F.col("lang")).cast("long")).filter("lang IS NOT NULL")
    sample = coded.filter(F.col("draw") < F.get(rates, F.col("lang"))).select("lang", "text")
    counted = sample.mapInArrow(lean(_counted), "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    columns = counted.groupBy("lang").applyInArrow(_column(smoothing), "lang long, log_prob binary").toArrow()
    # A language whose rows were all left out by the draw has nothing but the smoothing.
    log_prob = np.full((1 << BUCKET_BITS, len(languages)), -BUCKET_BITS * np.log(2), np.float32)
    for lang, column in zip(columns.column("lang").to_pylist(), columns.column("log_prob").to_pylist()):
        log_prob[:, lang] = np.frombuffer(column, "<f4")
    prior = np.array([totals[x] for x in languages], float)
    return Model(languages, np.log(prior / prior.sum()), log_prob)


def _scores(texts: list[str], model: Model) -> np.ndarray:
    """Log of prior times likelihood, text by language."""
    out = np.tile(model.log_prior, (len(texts), 1))
    cut = list(_segments(texts))
    step = max(1, (1 << 22) // len(model.languages))
    for a, b in packs([len(s) for _, s, _ in cut], min(SEGMENT, step)):
        added = np.zeros((b - a, len(model.languages)))
        for buckets, owner in _ngrams(*map(list, list(zip(*cut[a:b]))[1:])):
            for at in range(0, len(buckets), step):
                part = owner[at : at + step]
                first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
                added[part[first]] += np.add.reduceat(model.log_prob[buckets[at : at + step]], first, axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _, _ in cut[a:b]], added)
    return out


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score"
) -> DataFrame:
    """All rows and columns plus the likeliest language and its posterior probability."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in (pred_col, score_col) or c == text_col])
    schema = T.StructType([*kept.schema.fields, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_prob))
    at = kept.columns.index(text_col)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in smaller(batches, at, TEXT_BYTES):
            texts = [(t or b"").decode("utf-8", "replace") for t in batch.column(at).cast(pa.binary()).to_pylist()]
            known = [bool(model.languages) and any(map(str.isalpha, t)) for t in texts]
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if any(known):
                log = _scores([t for t, k in zip(texts, known) if k], model)
                best = log.argmax(axis=1)
                top = log.max(axis=1)
                posterior = 1 / np.exp(log - top[:, None]).sum(axis=1)
                for j, i in enumerate(np.flatnonzero(known)):
                    names[i], scores[i] = model.languages[best[j]], posterior[j]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], schema.fieldNames()
            )

    return kept.mapInArrow(lean(scored), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is in the fifth that training never sees; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5 == 0
