"""Secret scan: fixed patterns, and character Markov models of random strings and identifiers.

The base kinds are found by their patterns. A further kind, `markov`, comes from two
first-order character models: one of random strings, trained on the values that the
base patterns found, and one of ordinary identifiers, trained on words outside of
them that are shorter than a piece (whole texts of a sample of `sample_rows` rows, drawn by
hash). Candidates are looked for in the text with its base spans blanked out, so that what
is beside a base span is one too. A long run of token characters is added whole if its mean
log-likelihood ratio per character pair exceeds `threshold`. In the other runs each piece
between separators, from `min_piece` characters on, is added if its ratios add up to more
than `evidence`: a random string at the end of a path counts by itself, a short one needs
more in each pair. No added span touches a base span. Pairs are smoothed towards the share of
their second character; without any sample both models are equal and nothing is added.

All of it is column expressions. Positions come from splitting a text at its matches:
the lengths of the parts and matches before one add up to its start. Counts of pairs
have alphabet squared entries at most, whatever the data.

Edge cases: a null text counts as empty and has no spans. Only id and text are read.
Rows that repeat an id are scanned each by itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import saved

# The base patterns, in the order in which kinds are listed.
BASE = {
    "assign": r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
}
MARKOV = "markov"
CANDIDATES = ("run", "piece")
MIN_VALUE = 12
PRIOR = 20
ALPHABET = string.ascii_letters + string.digits + "+/_.=-"
_RUN = r"[A-Za-z0-9+/_.=-]"
_PIECE = r"[A-Za-z0-9+]"
_IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_.-]{5,}"


def _blanked(rows: DataFrame) -> DataFrame:
    """Rows with `rest`, the text with every base match replaced by as many spaces, so that places stay the same.

    One projection for each step, so that no pattern is looked for twice.
    """
    rest = F.col("rest")
    rows = rows.withColumn("rest", F.col("text"))
    for kind, pattern in BASE.items():
        value = F.regexp_extract_all(rest, F.lit(pattern), F.lit(2)) if kind == "assign" else F.col("whole")
        zipped = F.arrays_zip(F.split(rest, pattern, -1).alias("part"), F.col("whole"), value.alias("value"))
        least = MIN_VALUE if kind == "assign" else 0

        def kept(x: Column) -> Column:
            found = F.coalesce(x["whole"], F.lit(""))
            blank = F.repeat(F.lit(" "), F.char_length(found))
            return F.concat(x["part"], F.when(F.char_length(x["value"]) >= least, blank).otherwise(found))

        rows = rows.withColumn("whole", F.regexp_extract_all(rest, F.lit(pattern), F.lit(0)))
        rows = rows.withColumn("rest", F.when(F.size("whole") > 0, F.array_join(F.transform(zipped, kept), "")).otherwise(rest))
    return rows.drop("whole")


def _matches(text: str, kind: str, pattern: str) -> Column:
    """(gap, size, value) of each match in the column `kind` and of the end of the text, null if nothing matches."""
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else F.col(kind)
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("part"), F.col(kind).alias("whole"), value.alias("value"))
    spans = F.transform(
        zipped,
        lambda x: F.struct(
            F.char_length(x["part"]).alias("gap"), F.char_length(x["whole"]).alias("size"), x["value"].alias("value")
        ),
    )
    return F.when(F.size(kind) > 0, spans).alias(kind)


def scan(docs: DataFrame, id_col: str, text_col: str, min_run: int, min_piece: int, sample_rows: int) -> DataFrame:
    """One row per document: each kind's matches, the lengths around them, and sample identifiers."""
    total = max(1, docs.count())
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    patterns = {kind: ("text", pattern) for kind, pattern in BASE.items()}
    patterns |= {"run": ("rest", f"{_RUN}{{{min_run},}}"), "piece": ("rest", f"{_PIECE}{{{min_piece},}}")}
    found = _blanked(rows).select("*", *[F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias(k) for k, (t, p) in patterns.items()])
    columns = [_matches(t, k, p) for k, (t, p) in patterns.items()]
    drawn = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(1 << 30)) < int(min(1.0, sample_rows / total) * (1 << 30))
    identifiers = F.when(drawn, F.regexp_extract_all("rest", F.lit(_IDENTIFIER), F.lit(0)))
    return saved(found.select("row", "doc_id", *columns, identifiers.alias("identifiers")), "secrets")


def placed(found: DataFrame) -> DataFrame:
    """(row, kind, kind_no, start, end, value) of all matches, by kind."""
    order = Window.partitionBy("row", "kind_no").orderBy("i")
    kinds = [*BASE, *CANDIDATES]

    def numbered(n: int, kind: str) -> Column:
        return F.transform(
            F.col(kind),
            lambda x, i: F.struct(F.lit(n).alias("kind_no"), F.lit(kind).alias("kind"), i.alias("i"), x.alias("x")),
        )

    listed = [numbered(n, k) for n, k in enumerate(kinds)]
    together = F.concat(*[F.coalesce(x, F.array().cast("array<struct<kind_no:int,kind:string,i:int,x:struct<gap:int,size:int,value:string>>>")) for x in listed])
    rows = found.filter(" OR ".join(f"{k} IS NOT NULL" for k in kinds)).select("row", F.explode(together).alias("m"))
    rows = rows.select("row", "m.kind_no", "m.kind", "m.i", "m.x.gap", F.coalesce("m.x.size", F.lit(0)).alias("size"), "m.x.value")
    end = F.sum(F.col("gap") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).filter("size > 0").drop("gap", "size", "i")


def _pairs(strings: DataFrame, label: str) -> DataFrame:
    """Counts of neighbouring characters in a column `value`."""
    chars = strings.select(F.split("value", "").alias("c")).select(
        F.explode(F.transform(F.expr("slice(c, 1, greatest(size(c) - 1, 0))"), lambda a, i: F.concat(a, F.get("c", i + 1)))).alias("pair")
    )
    return chars.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).withColumn("label", F.lit(label))


def train(random: DataFrame, identifiers: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of the alphabet, row by first character.

    Both inputs are samples in a column `value`.
    """
    size = len(ALPHABET)
    counts = {label: [[0] * size for _ in range(size)] for label in ("random", "identifier")}
    for r in _pairs(random, "random").unionByName(_pairs(identifiers, "identifier")).collect():  # alphabet squared at most
        if len(r["pair"]) == 2 and all(c in ALPHABET for c in r["pair"]):
            counts[r["label"]][ALPHABET.index(r["pair"][0])][ALPHABET.index(r["pair"][1])] += r["n"]
    random_one, identifier = (_transitions(counts[label]) for label in ("random", "identifier"))
    return [math.log(x) - math.log(y) for x, y in zip(random_one, identifier)]


def _transitions(counts: list[list[int]]) -> list[float]:
    """Probability of the second character after the first, drawn towards its overall share."""
    size = len(counts)
    seen = [sum(row[b] for row in counts) + 0.5 for b in range(size)]
    share = [x / sum(seen) for x in seen]
    return [(row[b] + PRIOR * share[b]) / (sum(row) + PRIOR) for row in counts for b in range(size)]


def total_ratio(value: Column, ratio: list[float]) -> Column:
    """Log-likelihood ratios of a string's character pairs, added up."""
    table = F.split(F.lit(",".join(repr(x) for x in ratio)), ",").cast("array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    steps = F.zip_with(
        F.slice(codes, F.lit(1), F.greatest(F.size(codes) - 1, F.lit(0))),
        F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0))),
        lambda a, b: F.get(table, a * len(ALPHABET) + b),
    )
    return F.aggregate(steps, F.lit(0.0), lambda t, x: t + F.coalesce(x, F.lit(0.0)))


def _apart(spans: DataFrame, others: DataFrame) -> DataFrame:
    """The spans that touch none of the others in their text."""
    o = others.select(F.col("row").alias("o_row"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    touches = (F.col("row") == F.col("o_row")) & (F.col("start") < F.col("o_end")) & (F.col("o_start") < F.col("end"))
    return spans.join(o, touches, "left_anti")


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_run: int = 20,
    threshold: float = 1.0,
    min_piece: int = 12,
    evidence: float = 12.0,
    sample_rows: int = 20_000,
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans) for every row."""
    found = scan(docs, id_col, text_col, min_run, min_piece, sample_rows)
    matches = saved(placed(found), "spans")
    base = matches.filter(
        F.col("kind").isin(*BASE) & ((F.col("kind") != "assign") | (F.char_length("value") >= MIN_VALUE))
    )
    words = found.select(F.explode("identifiers").alias("value")).filter(F.char_length("value") < min_piece)
    ratio = train(base.select("value"), words)
    scored = matches.filter(F.col("kind").isin(*CANDIDATES)).withColumn("total", total_ratio(F.col("value"), ratio))
    pairs = F.greatest(F.char_length("value") - 1, F.lit(1))
    enough = F.when(F.col("kind") == "run", F.col("total") / pairs > threshold).otherwise(F.col("total") > evidence)
    spans_of = ["row", "kind_no", "kind", "start", "end"]
    random = saved(scored.filter(enough).select(*spans_of), "random")
    runs = random.filter("kind = 'run'")
    pieces = _apart(random.filter("kind = 'piece'"), runs)
    # A base span of one kind can begin inside one of another kind, and its end is then not blanked out.
    added = _apart(runs.unionByName(pieces), base).withColumn("kind_no", F.lit(len(BASE))).withColumn("kind", F.lit(MARKOV))
    spans = base.select(*spans_of).unionByName(added)
    said = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    every = F.sort_array(F.collect_list(F.struct("start", "kind_no", "end", "kind")))
    per_row = spans.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in (*BASE, MARKOV)], every.alias("all")
    )
    joined = found.select("row", "doc_id").join(per_row, "row", "left")
    listed = F.coalesce("all", F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"))
    of_base = F.concat_ws(",", F.transform(F.filter(listed, lambda x: x["kind"] != MARKOV), said))
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in (*BASE, MARKOV)],
        F.sha2(of_base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(listed, said)).alias("spans"),
    )
