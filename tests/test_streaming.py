"""Stream results against batch results, with replay, restart, repeats and bad messages."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.operators import rank_summary, rules, state
from postlens.schema import STATE_TABLES, classified_schema, post_schema
from postlens.sources import codec, readers, writers
from postlens.streaming import job, state_store


def scorer(df):
    return rules.classify_first(df, "text", ["leak"], ["fast"])


def post(key, day=1, source="reddit", text="a leak in words", **more):
    return {
        "post_id": key, "timestamp": f"2024-01-{day:02d} 10:00:00", "source": source,
        "subreddit": None, "text": text, "upvotes": 1, "comments": 0, **more,
    }


def put(folder, name, messages):
    folder.mkdir(exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


@pytest.fixture
def run(spark, tmp_path):
    def go(**options):
        rate = options.pop("rate_limit", None)
        messages = readers.read_stream(spark, "text", path=str(tmp_path / "in"), rate_limit=rate)
        query = job.start_classify(
            messages, scorer, str(tmp_path / "state"), str(tmp_path / "checkpoint"), **options
        )
        query.awaitTermination()
        return query

    return go


def totals(spark, tmp_path, name="overall_stats"):
    return {tuple(r)[:-1]: tuple(r)[-1] for r in state_store.read_state(spark, str(tmp_path / "state"), name).collect()}


def test_state_before_the_first_batch_is_empty(spark, tmp_path):
    for name in STATE_TABLES:
        assert state_store.read_state(spark, str(tmp_path / "state"), name).count() == 0


def test_many_batches_equal_one_batch_run(spark, tmp_path, run):
    texts = ["a leak in words", "fast words here", "plain words again"]
    data = [post(i, 1 + i % 3, "reddit" if i % 2 else "twitter", texts[i % 3]) for i in range(30)]
    for i in range(5):
        put(tmp_path / "in", f"part{i}", data[i * 6 : i * 6 + 6])
    run(rate_limit=1)
    whole = scorer(spark.createDataFrame([json.dumps(d) for d in data], "string").transform(codec.decode_posts))
    whole = whole.withColumnRenamed("pred", "category")
    daily = state.daily_delta(whole)
    for name, expected in {
        "daily_stats": daily, "overall_stats": state.overall_delta(daily), "top_keywords": state.keyword_delta(whole),
    }.items():
        assert totals(spark, tmp_path, name) == {tuple(r)[:-1]: tuple(r)[-1] for r in expected.collect()}
    assert len(list((tmp_path / "state" / "overall_stats").glob("batch_id=*"))) == 5


def test_replay_after_a_lost_commit_counts_once(spark, tmp_path, run):
    for i in range(3):
        put(tmp_path / "in", f"part{i}", [post(i), post(10 + i, text="fast")])
    run(rate_limit=1)
    before = totals(spark, tmp_path), totals(spark, tmp_path, "top_keywords")
    commits = sorted(p for p in (tmp_path / "checkpoint" / "commits").iterdir() if not p.name.startswith("."))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run(rate_limit=1)
    assert (totals(spark, tmp_path), totals(spark, tmp_path, "top_keywords")) == before


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post(1), post(2)])
    run()
    run()
    assert totals(spark, tmp_path) == {(0,): 2}
    put(tmp_path / "in", "part1", [post(3, text="fast")])
    run()
    assert totals(spark, tmp_path) == {(0,): 2, (1,): 1}


@pytest.mark.parametrize("mode, expected", [("none", 6), ("state", 3), ("keyed", 3), ("watermark", 3)])
def test_repeated_posts(spark, tmp_path, run, mode, expected):
    put(tmp_path / "in", "part0", [post(1), post(2), post(2)])
    run(dedup=mode)
    put(tmp_path / "in", "part1", [post(2), post(1), post(3)])
    run(dedup=mode)
    assert sum(totals(spark, tmp_path).values()) == expected


def test_unknown_dedup_mode(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post(1)])
    with pytest.raises(ValueError):
        run(dedup="often")


def test_processing_day(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post(1), post(2, day=9)])
    run(day="created_at")
    days = {k[0] for k in totals(spark, tmp_path, "daily_stats")}
    today = spark.range(1).select(F.current_date()).first()[0]
    assert len(days) == 1 and abs((days.pop() - today).days) <= 1


def test_compaction_keeps_totals_and_takes_later_batches(spark, tmp_path, run):
    for i in range(4):
        put(tmp_path / "in", f"part{i}", [post(i)])
    run(rate_limit=1)
    before = totals(spark, tmp_path, "top_keywords")
    folder = str(tmp_path / "state")
    state_store.compact(spark, folder, 1)
    assert totals(spark, tmp_path, "top_keywords") == before
    state_store.compact(spark, folder, 1)
    state_store.compact(spark, folder, 3)
    assert totals(spark, tmp_path, "top_keywords") == before
    put(tmp_path / "in", "part9", [post(9)])
    run()
    assert totals(spark, tmp_path) == {(0,): 5}


def test_readers_open_the_live_snapshot_and_later_batches_only(spark, tmp_path, run):
    for i in range(6):
        put(tmp_path / "in", f"part{i}", [post(i)])
    run(rate_limit=1)
    folder, before = str(tmp_path / "state"), totals(spark, tmp_path, "top_keywords")
    names = lambda: [f.rpartition("/state/")[2] for f in state_store.live_folders(spark, folder, "top_keywords")]
    assert names() == [f"top_keywords/batch_id={i}" for i in range(6)] and state_store.expire(spark, folder) == []
    state_store.compact(spark, folder, 1)
    state_store.compact(spark, folder, 3)
    assert names() == ["top_keywords_snapshot/batch_id=3", "top_keywords/batch_id=4", "top_keywords/batch_id=5"]
    during = state_store.read_state(spark, folder, "top_keywords")
    state_store.compact(spark, folder, 4)
    gone = state_store.expire(spark, folder, keep=1)
    assert f"{folder}/top_keywords/batch_id=3" in gone and f"{folder}/top_keywords_snapshot/batch_id=1" in gone
    assert not any("classified" in g or "batch_id=4" in g or "batch_id=5" in g for g in gone)
    # A reader that began before the last compaction ends; all see the same counters.
    assert {tuple(r)[:2]: r[2] for r in during.collect()} == before == totals(spark, tmp_path, "top_keywords")
    state_store.compact(spark, folder, 4)
    assert names() == ["top_keywords_snapshot/batch_id=4", "top_keywords/batch_id=5"]
    put(tmp_path / "in", "part9", [post(9)])
    run()
    assert totals(spark, tmp_path) == {(0,): 7}


def test_a_crash_within_a_compaction_loses_nothing(spark, tmp_path, run, monkeypatch):
    for i in range(4):
        put(tmp_path / "in", f"part{i}", [post(i)])
    run(rate_limit=1)
    folder, tables = str(tmp_path / "state"), ("daily_stats", "overall_stats", "top_keywords")
    before = [totals(spark, tmp_path, t) for t in tables]
    state_store.compact(spark, folder, 0)
    real = state_store._summed
    for crash_at in range(3):
        calls = []

        def failing(spark_, folders, name):
            calls.append(name)
            if len(calls) > crash_at:
                raise RuntimeError("lost")
            return real(spark_, folders, name)

        with monkeypatch.context() as patch, pytest.raises(RuntimeError):
            patch.setattr(state_store, "_summed", failing)
            state_store.compact(spark, folder, 2)
        # Part of a snapshot that was being written is no part of the state.
        (tmp_path / "state" / "daily_stats_snapshot" / "batch_id=2").mkdir(parents=True, exist_ok=True)
        assert [totals(spark, tmp_path, t) for t in tables] == before
        assert state_store.expire(spark, folder) == []
    state_store.compact(spark, folder, 2)
    state_store.expire(spark, folder, keep=0)
    assert [totals(spark, tmp_path, t) for t in tables] == before


def test_compaction_refuses_batches_that_are_not_there(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post(1)])
    run()
    folder = str(tmp_path / "state")
    for upto in (5, 1, -1):
        with pytest.raises(ValueError):
            state_store.compact(spark, folder, upto)
    state_store.compact(spark, folder, 0)
    put(tmp_path / "in", "part1", [post(2)])
    run()
    assert totals(spark, tmp_path) == {(0,): 2}


def test_watermark_mode_loses_no_post_with_an_old_time(spark, tmp_path, run):
    for i, day in enumerate((10, 20, 1)):
        put(tmp_path / "in", f"part{i}", [post(i, day=day), post(i, day=day)])
        run(dedup="watermark")
    assert totals(spark, tmp_path) == {(0,): 3}


@pytest.mark.parametrize("mode", ["none", "state", "watermark"])
def test_one_job_stores_good_and_bad_messages(spark, tmp_path, run, mode):
    put(tmp_path / "in", "part0", [post(1), *BAD, post(2)])
    run(dedup=mode)
    put(tmp_path / "in", "part1", [BAD[0], post(3)])
    run(dedup=mode)
    assert totals(spark, tmp_path) == {(0,): 3}
    letters = state_store.read_dead_letters(spark, str(tmp_path / "state")).collect()
    assert sorted(r["value"] for r in letters) == sorted([*BAD, BAD[0]])
    assert {r["value"] for r in letters if r["batch_id"] == 0} == set(BAD)


BAD = ['{"post_id": 1, "text"', '{"post_id": "1rihows", "source": "reddit"}', '{"source": "reddit"}', "not json"]


def test_bad_messages_go_to_the_dead_letters(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post(1), *BAD, post(2)])
    run()
    assert totals(spark, tmp_path) == {(0,): 2}
    messages = readers.read_stream(spark, "text", path=str(tmp_path / "in"))
    job.start_dead_letters(messages, str(tmp_path / "dead"), str(tmp_path / "dead-checkpoint")).awaitTermination()
    letters = [r["value"] for r in spark.read.parquet(str(tmp_path / "dead")).collect()]
    assert sorted(letters) == sorted(BAD)


def test_split_bad_puts_each_message_in_one_side(spark):
    df = spark.createDataFrame([(json.dumps(post(1)),), (None,), *[(b,) for b in BAD]], "value string")
    good, bad = codec.split_bad(df)
    assert (good.count(), bad.count()) == (2, 4)
    good, bad = codec.split_bad(df, key="post_id")
    assert (good.count(), bad.count()) == (1, 5)


def test_string_ids_need_a_string_schema(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post("1rihows"), post("1abc")])
    run(schema=post_schema(T.StringType()))
    assert totals(spark, tmp_path) == {(0,): 2}


def test_decode_keeps_other_fields_of_a_bad_record(spark):
    df = spark.createDataFrame([(b,) for b in BAD], "value string")
    got = codec.decode_posts(df).collect()
    assert [r["post_id"] for r in got] == [1, None, None, None] or [r["post_id"] for r in got] == [None] * 4
    assert got[1]["source"] == "reddit"


def test_payload_always_serialises(spark):
    df = spark.createDataFrame([(1, None), (2, 'quote " and \n newline')], "post_id long, text string")
    sent = codec.to_payload(df, key="post_id")
    assert sent.columns == ["key", "value"]
    assert [json.loads(r["value"]) for r in sent.collect()] == [
        {"post_id": 1, "text": None}, {"post_id": 2, "text": 'quote " and \n newline'},
    ]


def test_classified_topic_round_trip(spark, tmp_path):
    put(tmp_path / "in", "part0", [post(1), post("x"), post(2, text="fast " * 40)])
    classified = job.classify_stream(readers.read_stream(spark, "text", path=str(tmp_path / "in")), scorer)
    topic = str(tmp_path / "topic")
    writers.write_stream_topic(classified, "text", str(tmp_path / "c1"), path=topic).awaitTermination()
    rows = codec.decode_posts(spark.read.text(topic), classified_schema()).collect()
    assert {(r["post_id"], r["category"]) for r in rows} == {(1, 0), (2, 1)}
    lines = job.read_classified_topic(spark, "text", path=topic)
    query = lines.writeStream.format("memory").queryName("lines").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r["line"] for r in spark.table("lines").collect()} == {
        "[Security Risk] [reddit] a leak in words...", "[Productivity Gain] [reddit] " + ("fast " * 40)[:80] + "...",
    }


def test_rows_are_stored_with_the_batch(spark, tmp_path, run):
    put(tmp_path / "in", "part0", [post(1), post(2)])
    run()
    schema = classified_schema()
    schema["timestamp"].dataType = T.TimestampType()
    stored = state_store.read_classified(spark, str(tmp_path / "state"), schema)
    assert {(r["post_id"], r["category"], r["batch_id"]) for r in stored.collect()} == {(1, 0, 0), (2, 0, 0)}
    assert Path(tmp_path / "state" / "classified_posts" / "batch_id=0").is_dir()


def test_job_with_a_trained_model(spark, tmp_path, run):
    from postlens.operators import classifier

    data = [(i, i % 2, "a leak of keys" if i % 2 == 0 else "fast and easy work") for i in range(40)]
    labelled = spark.createDataFrame(data, "post_id int, label int, text string")
    stages = [*classifier.feature_stages(buckets=200), classifier.logistic(max_iter=10)]
    model = classifier.fit_classifier(labelled, stages)
    put(tmp_path / "in", "part0", [post(1, text="leak keys"), post(2, text="easy work"), post(3, text=None)])
    messages = readers.read_stream(spark, "text", path=str(tmp_path / "in"))
    job.start_classify(
        messages, lambda df: classifier.score(df, model), str(tmp_path / "state"), str(tmp_path / "checkpoint"),
        pred="prediction",
    ).awaitTermination()
    got = totals(spark, tmp_path)
    assert sum(got.values()) == 3 and got[0,] >= 1 and got[1,] >= 1


def test_bounded_keywords_and_latency_over_compactions(spark, tmp_path, run):
    rng = random.Random(2)
    names = ["alpha", "bravo", "delta", "hotel", "india", "oscar", "tango", "victor"]
    word = lambda: names[min(int(rng.expovariate(0.5)), 7)]
    texts = [" ".join([rng.choice(["leak", "fast", "plain"]), *(word() for _ in range(6))]) for _ in range(60)]
    for i in range(4):
        put(tmp_path / "in", f"part{i}", [post(k, text=texts[k]) for k in range(i * 15, i * 15 + 15)])
    sizes = {state_store.KEYWORD_SUMMARY: 6, state_store.LATENCY_SUMMARY: 10}
    run(rate_limit=1, keyword_size=6, latency_steps=10)
    folder = str(tmp_path / "state")
    category = {"leak": 0, "fast": 1, "plain": 2}
    counts = Counter((category[t.split()[0]], w) for t in texts for w in t.split())
    expected = {
        (c, w, n) for c in range(3)
        for w, n in sorted(((w, n) for (d, w), n in counts.items() if d == c), key=lambda x: (-x[1], x[0]))[:3]
    }
    assert totals(spark, tmp_path, "top_keywords") == {}
    for upto in (None, 1, 2):
        if upto is not None:
            state_store.compact(spark, folder, upto, sizes)
            state_store.expire(spark, folder, keep=0)
        assert {tuple(r) for r in state_store.read_top_keywords(spark, folder, 3, 6).collect()} == expected
        latencies = state_store.read_summary(spark, folder, state_store.LATENCY_SUMMARY)
        [r] = rank_summary.quantiles(latencies, [0.5]).collect()
        assert (r.rows, r["rank"]) == (60, 31) and r.error <= 60 / 10 * 3
