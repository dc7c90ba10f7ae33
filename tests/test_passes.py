"""How often the texts are gone through: learners and scorers must not split them again for each pass."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from __spark_entry__ import queries
from postlens.operators import classifier, linear_tables, term_bayes, word_vectors, words
from postlens.streaming import state_store

DATA = [(i, i % 3, f"{'alpha beta' if i % 3 else 'gamma'} w{i % 7} w{i % 5} delta") for i in range(60)]


def counted(spark):
    """Labelled rows, and a count of how often a text was read."""
    reads = spark.sparkContext.accumulator(0)
    rdd = spark.sparkContext.parallelize(DATA, 2).map(lambda r: (reads.add(1), r)[1])
    return spark.createDataFrame(rdd, "post_id long, label int, text string"), reads


def test_a_fit_goes_through_the_texts_once(spark):
    df, reads = counted(spark)
    model = classifier.fit_classifier(df)
    assert reads.value == len(DATA)
    plain = classifier.Pipeline(stages=[*classifier.feature_stages(), classifier.logistic()]).fit(df)
    got, wanted = model.stages[-1].coefficientMatrix.toArray(), plain.stages[-1].coefficientMatrix.toArray()
    assert abs(got - wanted).max() < 1e-6 and model.stages[3].docFreq == plain.stages[3].docFreq


def test_all_folds_and_strengths_go_through_the_texts_once(spark):
    df, reads = counted(spark)
    table = classifier.out_of_fold(df, classifier.feature_stages(), "post_id", max_iter=3)
    assert reads.value == len(DATA) and table.count() == 3 * len(DATA)


def exchanged(df) -> str:
    """The plan's shuffles, one a line."""
    plan = df._jdf.queryExecution().toString()
    return "\n".join(line for line in plan.split("Physical Plan")[-1].splitlines() if "hashpartitioning" in line)


def words_of(df):
    return classifier.stop_word_remover().transform(classifier.tokenizer().transform(df)).drop("text", "words")


def test_linear_scores_shuffle_no_terms(spark):
    df = spark.createDataFrame(DATA, "post_id long, label int, text string")
    model = classifier.fit_classifier(df)
    scored = linear_tables.score_linear(words_of(df), linear_tables.linear_tables(spark, model), "post_id")
    assert "term" not in exchanged(scored)
    given = {r["post_id"]: (r["prediction"], r["confidence"]) for r in classifier.with_confidence(classifier.score(df, model)).collect()}
    assert all(given[r["post_id"]][0] == r["prediction"] and abs(given[r["post_id"]][1] - r["confidence"]) < 1e-9 for r in scored.collect())


def test_bayes_scores_shuffle_a_term_once(spark):
    df = words_of(spark.createDataFrame(DATA, "post_id long, label int, text string"))
    scored = term_bayes.score_terms(df, term_bayes.fit_terms(df), "post_id")
    assert not any("_key" in line and "term" in line for line in exchanged(scored).splitlines())


def test_pairs_are_counted_both_ways_and_without_rare_words(spark, rows):
    df = spark.createDataFrame([(["a", "a", "b", "x", "a"],), (["b", "a"],)], "filtered array<string>")
    got = rows(word_vectors.pair_counts(df, window=2, min_count=2))
    # a-a and a-b within two places, either way; a next to itself counts from both ends.
    assert got == [("a", "a", 2), ("a", "b", 4), ("b", "a", 4)]


@pytest.mark.parametrize("dedup", ["state", "keyed"])
def test_a_batch_without_new_repeats_stores_no_second_copy_of_its_texts(spark, tmp_path, dedup):
    """Every batch used to be written and shuffled whole, texts and all, before it was known what is new."""
    state = str(tmp_path / "state")
    columns = "post_id long, timestamp timestamp, source string, text string, category int, created_at timestamp"

    def batch(ids):
        df = spark.createDataFrame([(i, "s", f"text {i}", n % 3) for n, i in enumerate(ids)], "post_id long, source string, text string, category int")
        now = F.current_timestamp()
        return df.withColumns({"timestamp": now, "created_at": now}).select(*[c.split()[0] for c in columns.split(", ")])

    def stored():
        rows = state_store.read_classified(spark, state, T.StructType.fromDDL(columns))
        return sorted((r["batch_id"], r["post_id"]) for r in rows.collect())

    state_store.write_batch(batch([1, 2, 3]), 0, state, dedup)
    state_store.write_batch(batch([1, 2, 3]), 1, state, dedup)
    state_store.write_batch(batch([2, 4]), 2, state, dedup)
    assert not (tmp_path / "state" / "_incoming").exists()
    assert stored() == [(0, 1), (0, 2), (0, 3), (2, 4)]
    state_store.write_batch(batch([4, 5, 5, 6, 1, 1]), 3, state, dedup)
    assert stored() == [(0, 1), (0, 2), (0, 3), (2, 4), (3, 5), (3, 6)]
    state_store.write_batch(batch([1, 2, 3]), 1, state, dedup)
    assert stored() == [(0, 1), (0, 2), (0, 3), (2, 4), (3, 5), (3, 6)]


def test_grams_are_counted_without_a_table_of_all_of_a_map_task(spark, sf_dir):
    """Every map task used to hold all of its grams, nearly all of them rare, and to sort and spill them."""
    plan = queries()["c19_tfidf_ngram_features"](spark, sf_dir)._jdf.queryExecution().toString().split("Physical Plan")[-1]
    above, below = plan.split("Exchange", 1)
    assert "Aggregate" in above and "Aggregate" not in below


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("slice_bytes", [1, 1 << 25])
def test_grams_of_texts_that_cross_slices(spark, slice_bytes, n, monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", slice_bytes)
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch_rows)
    texts = [["a", "b", "a", "b", "a", "é", "a b"], [], ["b"], None, ["a", "a"], ["c"] * 9, ["b", "a"]]
    df = spark.createDataFrame([(t,) for t in texts], "filtered array<string>").coalesce(1)
    wanted = Counter(" ".join(t[i : i + k]) for t in texts if t for k in range(1, n + 1) for i in range(len(t) - k + 1))
    try:
        for rows in ("1", "2", "5", before):
            spark.conf.set(batch_rows, rows)
            assert {tuple(r) for r in words.gram_counts(df, "filtered", n).collect()} == set(wanted.items())
    finally:
        spark.conf.set(batch_rows, before)


def test_counted_grams_are_those_of_the_stages(spark):
    df = spark.createDataFrame([("The Token's free, the FREE token; ŒUVRE x y_1 2 token",), ("",), ("the",), ("Éa éA b",)], "text string")
    staged = classifier.Pipeline(stages=classifier.ngram_stages(n=3)[:-3]).fit(df).transform(df)
    wanted = Counter(g for r in staged.collect() for g in r["grams"])
    assert {tuple(r) for r in classifier.ngram_counts(df, n=3).collect()} == set(wanted.items())
    assert classifier.ngram_counts(df.limit(0)).collect() == []


@pytest.mark.parametrize("sizes", [(1, 3, 5), (1 << 23, 1 << 16, 1 << 21)])
def test_word_pairs_of_texts_that_cross_slices(spark, sizes, monkeypatch):
    for name, size in zip(("SLICE_BYTES", "PACK_CONTEXTS", "BLOCK_WORDS"), sizes):
        monkeypatch.setattr(word_vectors, name, size)
    rng = random.Random(8)
    texts = [[rng.choice("abcdefghijklmé") for _ in range(rng.randrange(14))] for _ in range(40)] + [None, [], ["a", None, "b", "", ""], ["rare"]]
    df = spark.createDataFrame([(t,) for t in texts], "filtered array<string>").coalesce(2)
    often = Counter(w for t in texts if t for w in t if w is not None)
    wanted = Counter()
    for t in (t for t in texts if t):
        wanted.update((a, b) for i, a in enumerate(t) for j, b in enumerate(t) if 0 < abs(i - j) <= 3)
    wanted = {p: n for p, n in wanted.items() if all(often[w] >= 2 for w in p)}
    batch_rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch_rows)
    try:
        for rows in ("2", before):
            spark.conf.set(batch_rows, rows)
            counts = word_vectors.pair_counts(df, window=3, min_count=2)
            assert {(r["word"], r["context"]): r["n"] for r in counts.collect()} == wanted
        packed = word_vectors.positive_pmi(word_vectors.pair_counts(df, window=3, min_count=2, packed=True))
    finally:
        spark.conf.set(batch_rows, before)
    by_row = word_vectors.positive_pmi(counts)
    one, two = ({r["word"]: r["vector"] for r in word_vectors.projected(w, size=7).collect()} for w in (packed, by_row))
    assert one.keys() == two.keys() and all(one[w] == pytest.approx(two[w], abs=1e-9) for w in one)
    sums = {r["word"]: tuple(r)[1:] for r in word_vectors.weight_sums(packed).collect()}
    rows = by_row.collect()
    assert sums.keys() == {r["word"] for r in rows}
    for word, found in sums.items():
        own = [r for r in rows if r["word"] == word]
        weights = [r["ppmi"] for r in own]
        assert found == pytest.approx((own[0]["word_n"], len(own), sum(w > 0 for w in weights), sum(weights), max(weights)))


def test_word_pairs_of_no_texts(spark):
    df = spark.createDataFrame([], "filtered array<string>")
    assert word_vectors.pair_counts(df).collect() == [] and word_vectors.fit_word_vectors(df).collect() == []


def test_word_pairs_are_not_rows_before_they_are_counted(spark, monkeypatch):
    """Each pair used to be a row of two strings, shuffled and joined to the words that are often."""
    df = spark.createDataFrame([(["a", "b"] * 2000,)] * 3, "filtered array<string>").coalesce(1)
    stored = {}
    whole = word_vectors.written
    monkeypatch.setattr(word_vectors, "written", lambda rows, name: stored.setdefault(name, whole(rows, name)))
    assert {tuple(r) for r in word_vectors.pair_counts(df).collect()} == {("a", "a", 23982), ("b", "b", 23982), ("a", "b", 35973), ("b", "a", 35973)}
    assert {name: rows.count() for name, rows in stored.items()} == {"slices": 3, "often": 2, "pair-counts": 2}


def test_word_vectors_are_fitted_without_rows_for_pairs(spark, monkeypatch):
    """The fit behind `c21_alt_models` used to store, shuffle and join a row for each pair, and eight for its draws."""
    rng = random.Random(9)
    df = spark.createDataFrame([([rng.choice("abcdefghij") for _ in range(60)],) for _ in range(30)], "filtered array<string>").coalesce(1)
    stored = []
    whole = word_vectors.written
    monkeypatch.setattr(word_vectors, "written", lambda rows, name: stored.append(whole(rows, name)) or stored[-1])
    one = {r["word"]: r["vector"] for r in word_vectors.fit_word_vectors(df, size=9).collect()}
    assert max(rows.count() for rows in stored) <= 11
    by_row = word_vectors.projected(word_vectors.positive_pmi(word_vectors.pair_counts(df)), size=9)
    two = {r["word"]: r["vector"] for r in by_row.collect()}
    assert one.keys() == two.keys() and all(one[w] == pytest.approx(two[w], abs=1e-9) for w in one)
