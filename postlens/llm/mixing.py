"""Mixing sources to target weights by Poisson replication.

A source's rate is its share of the targets times all rows of the targeted sources,
divided by its own rows. Every document draws a uniform number from the hash of its
key and a seed, which the inverted Poisson distribution of its rate turns into a number
of copies; the expected size of the mix is that of the input. The copies are exploded
and dealt out by another hash, and ordered by it, which shuffles the whole mix.

All of it is column expressions. Rates are one entry per target (a Python dict), so
nothing is joined and a hot source is not gathered anywhere; the shuffle key differs
for every copy. A rate over `MOST` is split into equal parts of at most `MOST`, each with
a draw of its own: sums of Poisson numbers are Poisson numbers of the summed rate. So a table
of steps is short at any rate, and all tables together are one text in the plan. The copies
of a row are generated one by one, as they are dealt out.

Edge cases: a source without a target, also null, keeps the rate 1, exactly one copy
of each row. Targets without rows are left out of the shares. A null key is replaced by
the text. Rows that repeat a key draw the same number of copies. An empty input gives
an empty output. A column named like the copy number is replaced.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TARGETS = 10_000
HASH_DIGITS = 13  # 52 bits of the md5 digest, exact in a double
MOST = 32.0  # largest mean of one draw


def poisson_cdf(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... up to where a 52-bit uniform number cannot reach."""
    total, out = 0.0, []
    for k in range(int(rate + 40 * math.sqrt(rate)) + 40):
        before, total = total, total + math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
        if k > rate and total == before:
            break
        out.append(total)
    return out


def rates(docs: DataFrame, targets: Mapping[str, float], source_col: str = "source") -> dict[str, float]:
    """Mean number of copies of a row, for each target that has rows; counts cover all rows."""
    if len(targets) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    if any(w <= 0 for w in targets.values()):
        raise ValueError("weights are positive")
    source = F.col(f"`{source_col}`")
    counted = docs.filter(source.isin(list(targets))).groupBy(source.alias("source")).agg(F.count(F.lit(1)).alias("n"))
    rows = {r["source"]: r["n"] for r in counted.collect()}  # a row per target at most
    whole = math.fsum(targets[s] for s in rows)
    return {s: targets[s] / whole * sum(rows.values()) / n for s, n in sorted(rows.items())}


def draws_of(rate: float) -> int:
    """How many equal draws make up a rate."""
    return max(1, math.ceil(rate / MOST))


def uniform(key: Column, seed: int, draw: Column) -> Column:
    """A number in [0, 1) fixed by key, seed and the number of the draw."""
    later = F.when(draw > 0, F.concat(F.lit("/"), draw.cast("string"))).otherwise("")
    digest = F.md5(F.concat(F.lit(str(seed)), later, F.lit(":"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("double") / F.lit(float(16**HASH_DIGITS))


def mix(
    docs: DataFrame,
    targets: Mapping[str, float],
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = 17,
    copy_col: str = "copy",
) -> DataFrame:
    """The documents, each as often as its draw says, in an order fixed by the seed; copies count from 1."""
    docs = docs.drop(copy_col)
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`"), F.lit(""))
    rate = rates(docs, targets, source_col)
    copies = F.lit(1)
    if rate:
        tables = {x: {"draws": draws_of(r), "steps": poisson_cdf(r / draws_of(r))} for x, r in rate.items()}
        known = F.from_json(F.lit(json.dumps(tables)), "map<string, struct<draws: int, steps: array<double>>>")
        mine = F.try_element_at(known, F.col(f"`{source_col}`"))
        numbers = F.transform(F.sequence(F.lit(0), mine["draws"] - 1), lambda j: uniform(key, seed, j))
        total = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter(mine["steps"], lambda c: c <= u)))
        copies = F.when(mine.isNull(), 1).otherwise(total)
    own = [F.col(f"`{c}`") for c in docs.columns]
    drawn_rows = docs.select(F.struct(*own).alias("doc"), copies.alias("copies"), key.alias("key")).filter("copies > 0")
    exploded = drawn_rows.select("doc", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    placed = exploded.select("doc", "copy", F.xxhash64(F.lit(seed), "key", "copy").alias("place"))
    shuffled = placed.repartition("place").sortWithinPartitions("place", "copy")
    return shuffled.select("doc.*", F.col("copy").alias(copy_col))


def mix_sql(targets: Mapping[str, float], seed: int = 17) -> str:
    """SQL over `documents` for the rows of a mix."""
    listed = ", ".join(f"('{s}', {w!r}::DOUBLE)" for s, w in targets.items())
    return f"""WITH target(source, w) AS (VALUES {listed}),
rows AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
rate AS (SELECT source, w / sum(w) OVER () * sum(n) OVER () / n AS r FROM rows JOIN target USING (source)),
parts AS (SELECT source, r / m AS r, m FROM (SELECT source, r, greatest(1, ceil(r / {MOST!r}::DOUBLE)) AS m FROM rate)),
pmf AS (SELECT source, m, k, exp(k * ln(r) - r - lgamma(k + 1)) AS p FROM parts, range(0, 400) t(k)),
cdf AS (SELECT source, m, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
steps AS (SELECT source, m, list(c) AS cs FROM cdf GROUP BY source, m),
copies AS (
  SELECT doc_id, d.source, CASE WHEN cs IS NULL THEN 1 ELSE list_sum(list_transform(range(0, CAST(m AS BIGINT)), lambda j:
    len(list_filter(cs, lambda c: c <= CAST('0x' || substr(md5('{seed}' || CASE WHEN j > 0 THEN '/' || j ELSE '' END || ':' || CAST(doc_id AS VARCHAR)), 1, {HASH_DIGITS}) AS BIGINT) / {16**HASH_DIGITS}.0)))) END AS n
  FROM documents d LEFT JOIN steps s ON s.source = d.source)
SELECT d.*, CAST(copy AS INTEGER) AS copy
FROM copies c JOIN documents d ON d.doc_id = c.doc_id, range(1, CAST(c.n AS BIGINT) + 1) t(copy)"""
