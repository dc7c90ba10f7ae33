"""Files, reports, the audit and the database writer."""

import json

import pytest
from pyspark.sql import types as T

from postlens import session
from postlens.schema import post_schema
from postlens.sources import readers, writers

TEXTS = [
    "plain", 'with "quotes", commas', "two\nlines\n\nand more", "back\\slash", "", None, " edge blanks ",
    "tab\tend\t", "line\r\nbreaks\rof\nall kinds", "\nstarts and ends\n", "#hash", "é 漢字 \U0001f600",
]


def test_csv_keeps_every_text(spark, tmp_path):
    schema = post_schema(T.StringType(), labelled=True)
    data = [(f"1r{i}", "2024-01-01 00:00:00", "reddit", None, t, i, 0, None) for i, t in enumerate(TEXTS)]
    path = str(tmp_path / "posts")
    writers.write_csv(spark.createDataFrame(data, schema), path)
    got = {r["post_id"]: r for r in readers.read_posts_csv(spark, path, schema).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        # CSV does not tell an empty field from a missing one.
        assert got[f"1r{i}"]["text"] == (text or None)
        assert got[f"1r{i}"]["upvotes"] == i
        assert got[f"1r{i}"]["subreddit"] is None


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "web.csv").write_text(
        "label,text,extra,upvotes,post_id,comments\n1.0,\"a, b\",x,7,9007199254740993,many\n,c,y,,2,3\n"
    )
    got = readers.read_posts_csv(spark, str(tmp_path / "web.csv"), post_schema(labelled=True))
    assert got.schema == post_schema(labelled=True)
    assert [(r["post_id"], r["text"], r["upvotes"], r["comments"], r["label"], r["source"]) for r in got.collect()] == [
        (9007199254740993, "a, b", 7, None, 1, None), (2, "c", None, 3, None, None),
    ]


def test_csv_overwrite_and_file_size(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_csv(spark.range(10), path)
    writers.write_csv(spark.range(100).coalesce(1), path, rows_per_file=30)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 4
    assert readers.read_posts_csv(spark, path, "id long").count() == 100


def response(posts, success=True):
    return json.dumps({"success": success, "data": {"posts": [{"data": p} for p in posts]}})


def test_api_dump(spark, tmp_path):
    full = {
        "id": "a1", "title": "T", "selftext": "body", "created_utc": 1711929600.0, "ups": 3, "downs": 1, "score": 2,
        "num_comments": 4, "author": "me", "link_flair_text": "f", "subreddit": "x", "permalink": "/p",
    }
    lines = [
        response([full, {"id": "a2", "title": "only title", "selftext": "  "}]), response([full], success=False),
        response([]), json.dumps({"success": True}), json.dumps({"success": True, "data": {"posts": [{}]}}), "broken {",
    ]
    (tmp_path / "dump.json").write_text("\n".join(lines))
    got = {r["post_id"]: r for r in readers.flatten_posts(readers.read_api_dump(spark, str(tmp_path / "dump.json"))).collect()}
    assert set(got) == {"a1", "a2", ""}
    assert got["a1"]["text"] == "T body" and got["a1"]["timestamp"] == "2024-04-01 00:00:00"
    assert got["a1"]["permalink"] == "https://www.reddit.com/r/x/comments/a1"
    assert got["a2"]["text"] == "only title"
    assert (got["a2"]["author"], got["a2"]["upvotes"], got["a2"]["timestamp"]) == ("unknown", 0, "1970-01-01 00:00:00")
    limited = readers.flatten_posts(readers.read_api_dump(spark, str(tmp_path / "dump.json")), "fixed", limit=1)
    assert {r["subreddit"] for r in limited.collect()} == {"r/fixed"} and limited.count() == 2
    dotted = readers.flatten_posts(readers.read_api_dump(spark, str(tmp_path / "dump.json")), sep=". ", skip="never")
    assert {r["text"] for r in dotted.collect()} == {"T. body", "only title.   ", ". "}


def test_report(spark, tmp_path):
    path = str(tmp_path / "report")
    writers.write_report(spark.createDataFrame([(1, None)], "n int, rate double"), spark.range(3), path)
    lines = [f.read_text() for f in (tmp_path / "report" / "metrics").glob("*.json")]
    assert [json.loads(line) for line in lines if line] == [{"n": 1, "rate": None}]
    assert spark.read.json(f"{path}/results").count() == 3


def test_audit_names_missing_outputs(spark, tmp_path):
    writers.write_csv(spark.createDataFrame([("a\nb",), ("c",)], "t string"), str(tmp_path / "there"))
    report = readers.audit_outputs(spark, {"there": str(tmp_path / "there"), "gone": str(tmp_path / "gone")})
    assert {tuple(r) for r in report.collect()} == {("there", 2, True), ("gone", None, False)}


class FakeWriter:
    """Takes the calls a DataFrameWriter would; no database is needed to see them."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        return self.option("format", name)

    def options(self, **more):
        self.calls.update(more)
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def mode(self, name):
        return self.option("mode", name)

    def save(self):
        self.calls["saved"] = True


def test_jdbc_appends_over_bounded_connections():
    class Frame:
        write = FakeWriter()

    writers.write_jdbc(Frame, "jdbc:x", "classified_posts", {"user": "u", "driver": "d"}, connections=4)
    calls = Frame.write.calls
    assert calls["saved"] and calls["mode"] == "append" and calls["format"] == "jdbc"
    assert (calls["url"], calls["dbtable"], calls["numPartitions"], calls["user"]) == ("jdbc:x", "classified_posts", 4, "u")


def test_stream_options_for_a_topic():
    class Reader:
        def __init__(self):
            self.calls = {}

        def format(self, name):
            return self.option("format", name)

        def option(self, name, value):
            self.calls[name] = value
            return self

        def options(self, **more):
            self.calls.update(more)
            return self

        def load(self, *path):
            return self.calls

    class Session:
        readStream = Reader()

    calls = readers.read_stream(Session, "kafka", rate_limit=100, subscribe="raw-posts")
    assert calls == {
        "format": "kafka", "startingOffsets": "latest", "maxOffsetsPerTrigger": "100", "subscribe": "raw-posts",
    }


@pytest.mark.parametrize("other, same", [("post_id,comments,upvotes\n3,10,20\n", False), ("post_id,upvotes,comments\n3,20,10\n", True)])
def test_columns_are_never_taken_by_place(spark, tmp_path, other, same):
    (tmp_path / "a.csv").write_text("post_id,upvotes,comments\n1,5,6\n2,7,8\n")
    (tmp_path / "b.csv").write_text(other)
    schema = "post_id long, upvotes int, comments int"
    both = readers.read_posts_csv(spark, str(tmp_path), schema)
    if same:
        assert sorted(tuple(r) for r in both.collect()) == [(1, 5, 6), (2, 7, 8), (3, 20, 10)]
        return
    with pytest.raises(Exception, match="(?i)header"):
        both.collect()
    apart = [readers.read_posts_csv(spark, str(tmp_path / n), schema) for n in ("a.csv", "b.csv")]
    assert sorted(tuple(r) for r in apart[0].unionByName(apart[1]).collect()) == [(1, 5, 6), (2, 7, 8), (3, 20, 10)]


def test_a_null_mark_tells_null_from_empty(spark, tmp_path):
    rows = spark.createDataFrame([(1, ""), (2, None), (3, "x\ny")], "post_id long, text string")
    writers.write_csv(rows, str(tmp_path / "out"), null_mark="\\N")
    back = readers.read_posts_csv(spark, str(tmp_path / "out"), rows.schema, null_mark="\\N")
    assert sorted(tuple(r) for r in back.collect()) == [(1, ""), (2, None), (3, "x\ny")]


def test_shared_dir_is_the_configured_one(spark):
    assert session.new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shared_dir_must_be_set_on_a_cluster():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.shared_dir(Cluster)
