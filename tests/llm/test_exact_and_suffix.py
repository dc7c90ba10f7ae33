import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_data import documents, with_clashes, words

from postlens.llm import exact_dedup, suffix_dedup

TEXTS = [None, "", " ", "\t\n", "a  b", "a b", "a\x0bb", " a b", "x" * 100, "x" * 99, "ab" * 40, "ab" * 40, "ab" * 39 + "ac", "é" * 33, "é" * 33]


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected_groups(texts):
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(normalised(t), []).append(i)
    return {
        i: (g[0], len(g), i == g[0], hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    }


@pytest.mark.parametrize("block", [8, 4096])
def test_exact_dedup_equals_brute_force(spark, block):
    rng = random.Random(1)
    texts = TEXTS + [words(rng, rng.randrange(60), 3) for _ in range(60)]
    docs = with_clashes(documents(spark, texts), "row", "name", "block", "digest", "keep_id")
    got = {r[0]: tuple(r)[1:] for r in exact_dedup.exact_dedup(docs, block_bytes=block).collect()}
    assert got == expected_groups(texts)


def test_exact_dedup_ids_that_are_null_or_repeat(spark):
    docs = documents(spark, ["a", "a", "a", "b", "b", "c", "c"], [None, 7, 7, None, None, 3, 3])
    rows = exact_dedup.exact_dedup(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in rows) == [
        ("3", "3", 2), ("3", "3", 2), ("7", "7", 3), ("7", "7", 3), ("None", "7", 3), ("None", "None", 2), ("None", "None", 2)
    ]
    assert sum(r.kept for r in rows) == 3
    kept = exact_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted((r.text, str(r.doc_id)) for r in kept.collect()) == [("a", "7"), ("b", "None"), ("c", "3")]


def test_exact_dedup_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.exact_dedup(docs).collect() == []
    assert exact_dedup.kept_rows(docs).collect() == []


def removed(rows, size):
    """Brute force over all windows; rows are (id, bytes) in order."""
    seen, out = set(), []
    for i, t in rows:
        keep = [True] * len(t)
        for k in range(len(t) - size + 1):
            window = t[k : k + size]
            if window in seen:
                keep[k : k + size] = [False] * size
            seen.add(window)
        spans = re.findall("0+", "".join("01"[x] for x in keep))
        left = bytes(c for c, x in zip(t, keep) if x)
        out.append((i, len(t), keep.count(False), len(spans), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("size", [9, 40])
def test_suffix_dedup_equals_brute_force(spark, size, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    rng = random.Random(size)
    shared = [words(rng, 12, 50) for _ in range(4)]
    texts = TEXTS + ["\x00" * 60, "\x00" * 59 + "\x01", "ß" * 50]
    for _ in range(60):
        texts.append(" ".join(rng.choice([words(rng, rng.randrange(12), 50), rng.choice(shared)]) for _ in range(3)))
    texts += texts[20:26]
    docs = with_clashes(documents(spark, texts), "key", "tkey", "spans", "start")
    got = sorted(tuple(r) for r in suffix_dedup.suffix_dedup(docs, size).collect())
    assert got == removed([(i, (t or "").encode()) for i, t in enumerate(texts)], size)


def test_suffix_dedup_splits_a_hot_passage(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_WINDOWS", 200, raising=False)
    monkeypatch.setattr(suffix_dedup, "CHUNK_WINDOWS", 300)
    rng = random.Random(3)
    passage = words(rng, 20, 50)
    texts = ["\x00" * 45, *(f"{words(rng, 9)} {passage} {words(rng, 9)}" for _ in range(150)), "\x00" * 44 + "\x01"]
    texts += texts[5:9]
    docs = documents(spark, texts + ["again " + passage] * 2, [*range(len(texts)), 900, 900])
    dealt = []
    whole = suffix_dedup.dealt_runs
    monkeypatch.setattr(suffix_dedup, "dealt_runs", lambda *a: dealt.append((a[0], whole(*a))) or dealt[-1][1])
    got = sorted(tuple(r) for r in suffix_dedup.suffix_dedup(docs, 40).collect())
    expected = removed([(i, t.encode()) for i, t in enumerate(texts)] + [(900, b"again " + passage.encode())] * 2, 40)
    assert got == sorted(expected)

    def most(runs):
        each = runs.filter("gram IS NOT NULL").selectExpr("gram", "octet_length(bytes) - 39 AS n").groupBy("gram")
        return max(r.n for r in each.agg({"n": "sum"}).toDF("gram", "n").collect())

    [(found, after)] = dealt
    assert most(found) > 200 >= most(after)


def test_suffix_dedup_ids_that_are_null_or_repeat(spark):
    text = "0123456789" * 2
    docs = documents(spark, [text, text, text, text], [None, 5, 5, 9])
    got = sorted((str(r.doc_id), r.n_removed) for r in suffix_dedup.suffix_dedup(docs, 10).collect())
    # The first keeps its first ten bytes: the string of ten starts again at byte ten.
    assert got == [("5", 10), ("5", 20), ("9", 20), ("None", 20)]


def test_suffix_dedup_empty_table(spark):
    assert suffix_dedup.suffix_dedup(documents(spark, [])).collect() == []


def test_previous_and_next_smaller_positions():
    rng = np.random.default_rng(3)
    texts = rng.integers(0, 12, 500)
    position = rng.permutation(500)
    suffixes = np.array([f"{x:04d}".encode() for x in texts], "S4")
    expected = [any(texts[j] == texts[i] and position[j] < position[i] for j in range(500)) for i in range(500)]
    assert suffix_dedup.earlier_factor(suffixes, position).tolist() == expected


@pytest.mark.parametrize("segment", [7, 64, 1 << 14])
def test_runs_of_texts_in_a_row(segment, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
    rng = random.Random(segment)
    passage = words(rng, 20, 50).encode()
    texts = [b"", passage, b"short", passage, b"\x00" * 90, words(rng, 9).encode() + passage, passage[:40], passage[:39]]
    size = np.array([len(t) for t in texts])
    start = np.cumsum(size) - size
    columns = suffix_dedup.runs(np.frombuffer(b"".join(texts), np.uint8), start, size, 40)
    found = list(zip(*[x.tolist() for x in columns]))
    windows, anchors = [], {}
    for text, hashed, anchor, first, last in found:
        for w in range(first, last + 1):
            assert w <= anchor <= w + 30
            windows.append((text, w))
            anchors.setdefault(texts[text][w : w + 40], set()).add((hashed, anchor - w))
    assert windows == [(i, w) for i, t in enumerate(texts) for w in range(len(t) - 39)]
    assert all(len(x) == 1 for x in anchors.values())
    # A run goes on in the next segment.
    assert len({(t, a) for t, _, a, *_ in found}) == len(found)


@pytest.mark.parametrize("size", [1, 3, 7, 8, 9, 16, 24, 25])
def test_gram_hashes_tell_strings_apart(size):
    data = np.random.default_rng(size).integers(0, 2, 3000).astype(np.uint8)
    grams = [data[i : i + size].tobytes() for i in range(len(data) - size + 1)]
    hashed = suffix_dedup.gram_hashes(data, size).tolist()
    assert len(set(zip(grams, hashed))) == len(set(grams)) == len(set(hashed))
    assert not len(suffix_dedup.gram_hashes(data[:size - 1], size))


def test_covered_runs_that_touch_are_one_row():
    rng = random.Random(4)
    passage = words(rng, 300, 50)
    texts = [f"{x} {passage}".encode() for x in ("one", "other", "third")]
    places = [np.arange(len(t), dtype=np.uint32).tobytes() for t in texts]
    [packed] = suffix_dedup._packed([pa.RecordBatch.from_pydict({"key": [1, 2, 3], "tkey": [7, 8, 9], "text": texts})])
    batch = pa.RecordBatch.from_pydict({**{c: packed.column(c) for c in packed.schema.names}, "places": [[p] for p in places]})
    rows = pa.Table.from_batches(suffix_dedup._runs_of_repeats(40)(iter([batch]))).to_pylist()
    covered = [r for r in rows if r["gram"] is None]
    assert [(r["key"], r["tkey"], r["bytes"]) for r in covered] == [(2, 8, None), (3, 9, None)]
    assert all(r["first"] < 60 and r["first"] + r["size"] == len(texts[r["key"] - 1]) for r in covered)


def test_only_windows_that_share_a_hash_are_sorted(monkeypatch):
    rng = random.Random(5)
    passage = words(rng, 30, 50).encode()
    data = pa.array([words(rng, 30, 50).encode() + passage[:60], passage, words(rng, 30, 50).encode()])
    first = np.array([5, 0, 0])
    sorted_ = []
    whole = suffix_dedup.earlier_factor
    monkeypatch.setattr(suffix_dedup, "earlier_factor", lambda s, p: sorted_.append(len(s)) or whole(s, p))
    key, _, start, *_, hit = suffix_dedup._suffixes(np.array([3, 4, 5]), np.array([1, 1, 1]), first, data, 40)
    assert sorted_ == [2 * 21]
    assert list(zip(key[hit].tolist(), start[hit].tolist())) == [(4, w) for w in range(21)]
