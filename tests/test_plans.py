"""Shapes of plans that matter at scale."""

import re

import pytest

import __spark_entry__ as catalog

QUERIES = catalog.queries()


@pytest.mark.parametrize(
    "name", ["c5_weak_label", "b17_preview_projection", "d10_clean_attrition", "c8_hashing_tf", "e1_top_keywords", "d4_word_freq"]
)
def test_no_whole_text_goes_through_a_join(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    spark_plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = spark_plan.split("\n")
    depth = [len(re.match(r"[ :+|-]*", line)[0]) for line in lines]
    for i, line in enumerate(lines):
        if " Join " not in line and not re.match(r"[ :+|-]*Join ", line):
            continue
        for j in range(i + 1, len(lines)):
            if depth[j] <= depth[i]:
                break
            if depth[j] == depth[i] + 3:  # what the join takes in
                assert not re.search(r"Project \[[^\]]*(?<!AS )(?<![(\w])text#\d+(?=[,\]])", lines[j]), lines[j]


def test_no_query_asks_how_many_cores_there_are():
    from pathlib import Path

    for path in (Path(catalog.__file__).parent / "postlens").rglob("*.py"):
        if "catalog" not in path.parts:
            assert "defaultParallelism" not in path.read_text(), path
