import random

import numpy as np
import pytest
from llm_data import documents, near_copies, with_clashes, words

from postlens.llm import components, ngram_join


def gram_set(text, n):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    w = [x for x in text.split(" ") if x]
    k = min(n, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()


def classes(texts, n, num, den=100):
    sets = [gram_set(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(i, len(s), find(i)) for i, s in enumerate(sets)]


EDGES = [
    None, "", " \n", "one", "ONE", "one two", "Two one", "one two three", "one\ttwo  three", "one two three four", "É x y", "é x y",
    "a b c d e f g h i j k", "a b c d e f g h i j l", "\x00 a", "\x00\x00 a", "a \xa0 b c",
]


@pytest.mark.parametrize("n,num", [(3, 90), (5, 80), (1, 50)])
def test_classes_equal_brute_force(spark, n, num):
    texts = EDGES + near_copies() + [words(random.Random(i), 30, 8) for i in range(40)]
    texts += texts[20:30]
    docs = with_clashes(documents(spark, texts), "key", "tkey", "sid", "label", "component_id").repartition(5)
    got = sorted(tuple(r) for r in ngram_join.link_classes(docs, n, num).collect())
    assert got == classes(texts, n, num)


def test_blocks_of_hot_lists_and_groups_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 4)
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 3)
    monkeypatch.setattr(ngram_join, "HOT_IN_CHUNK", 2)
    monkeypatch.setattr(ngram_join, "SEGMENT", 100)
    texts = near_copies(seed=11, groups=3, size=25)
    got = sorted(tuple(r) for r in ngram_join.link_classes(documents(spark, texts).repartition(2), 3, 80).collect())
    assert got == classes(texts, 3, 80)


def test_one_per_class_keeps_the_least_id_and_all_columns(spark):
    texts = near_copies(groups=3)
    docs = with_clashes(documents(spark, texts), "tkey", "_key").repartition(3)
    kept = ngram_join.one_per_class(docs, 5, 80)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in classes(texts, 5, 80)})


def test_null_and_repeated_ids_and_an_empty_table(spark):
    assert ngram_join.link_classes(documents(spark, [])).collect() == []
    docs = documents(spark, ["a b c d", "a b c d", "a b c d", "x y z", "x y z", "", ""], [None, 4, 4, None, None, 1, 1])
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.link_classes(docs).collect())
    assert got == [
        ("1", 0, "1"), ("1", 0, "1"), ("4", 2, "4"), ("4", 2, "4"), ("None", 1, "None"), ("None", 1, "None"), ("None", 2, "4")
    ]
    kept = sorted((str(r.doc_id), r.text) for r in ngram_join.one_per_class(docs, 3, 90).collect())
    assert kept == [("1", ""), ("1", ""), ("4", "a b c d"), ("None", "x y z")]


def test_words_do_not_depend_on_segments(monkeypatch):
    text = (words(random.Random(1), 300) + "  ").encode()
    whole = list(ngram_join.gram_sets(ngram_join.Words(), [text, b"", text], 3))
    monkeypatch.setattr(ngram_join, "SEGMENT", 50)
    parts = list(ngram_join.gram_sets(ngram_join.Words(), [text, b"", text], 3))
    assert all((a == b).all() for a, b in zip(whole, parts)) and not len(parts[1])


@pytest.mark.parametrize("num", [50, 80, 90])
def test_histograms_never_bound_an_overlap_too_low(num):
    rng = np.random.default_rng(1)
    for _ in range(50):
        size = int(rng.choice([200, 600, 25_000]))
        a, b = (np.unique(rng.integers(0, 2**64, size, np.uint64)) for _ in range(2))
        a = np.union1d(a, b[: rng.integers(0, size)])
        bins = ngram_join.Histograms([ngram_join.histogram(x, num, 100) for x in (a, b)])
        both = len(np.intersect1d(a, b))
        assert bins.common(np.array([0]), np.array([1]), np.array([0]))[0] >= both


def test_components_of_random_graphs(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(40)]
    root = list(range(600))
    for _ in range(600):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root[x] for e in edges if e[0] != e[1] for x in e}


def linked_classes(edges, count):
    root = list(range(count))
    for a, b in edges:
        old, new = max(root[a], root[b]), min(root[a], root[b])
        root = [new if r == old else r for r in root]
    return root


@pytest.mark.parametrize("num", [50, 80, 90])
def test_skipped_blocks_hold_no_pair_that_may_link(monkeypatch, num):
    monkeypatch.setattr(ngram_join, "SKIP_BLOCK", 4)
    rng = np.random.default_rng(num)
    skipped = 0
    for count in (1, 3, 4, 5, 90):
        n = np.sort(rng.integers(20, 200, count))
        pos = (rng.random(count) * [ngram_join.prefix_size(int(x), num, 100) for x in n]).astype(np.int64)
        own = [np.unique(rng.integers(0, 2**64, int(x), np.uint64)) for x in n]
        bins = ngram_join.Histograms([ngram_join.histogram(x, num, 100) for x in own])
        bins.common = lambda a, b, least: least  # sizes and positions alone decide
        rows = np.arange(count)
        links = ngram_join._ListLinks(rows, n, pos, bins, num, 100)
        every = []
        for i in range(count):
            hit = rows[ngram_join._may_link(n, pos, bins, rows, np.int64(i), num, 100)]
            inside = links.table[links.blocks(i)].ravel()
            assert set(hit) <= set(inside.tolist())
            skipped += len(links.table) - len(links.blocks(i))
            every += [(i, int(j)) for j in hit]
        found = ngram_join._spread(links)
        assert linked_classes(found, count) == linked_classes(every, count)
        assert len(found) == count - len(set(linked_classes(every, count)))
    assert skipped > 100


def test_answers_derived_from_a_near_set_equal_whole_intersections():
    rng = np.random.default_rng(5)
    pools = [rng.integers(0, 2**64, 120, np.uint64) for _ in range(4)]
    sets = [np.unique(np.r_[rng.choice(pools[i % 4], 100, False), rng.integers(0, 2**64, 3, np.uint64)]) for i in range(40)]
    sets.append(np.zeros(0, np.uint64))  # the pivot's own difference
    links = ngram_join._GroupLinks(np.full(41, 200), sets, 90, 100)
    order = []
    counted = links._counted
    read = []
    links._counted = lambda codes: (read.append(len(codes)), counted(codes))[1]
    for _ in range(41):
        order.append(links.first())
        common = links.answered(order[-1])
        for j in range(41):
            if j != order[-1]:
                assert common[j] == len(np.intersect1d(sets[order[-1]], sets[j]))
    assert links.first() == -1 and sorted(order) == list(range(41))
    assert sum(read) < 0.7 * sum(len(s) for s in sets)  # fewer lists than counting each set anew
    assert (links.nearest[order[-8:]] >= 0).all()


def test_large_groups_meet_their_pivot_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_BLOCK", 4)
    rows = spark.range(101).selectExpr("IF(id < 100, 7L, 8L) root", "id sid")
    sizes = rows.groupBy("root").count().selectExpr("root", "CAST(ceil(count / 4) AS INT) parts")
    got = ngram_join._in_parts(rows, sizes).collect()
    assert len(got) == 101 and {r.parts for r in got if r.root == 7} == {25}
    assert [(r.parts, r.mine) for r in got if r.root == 8] == [(1, 0)]
    assert len({r.mine for r in got if r.root == 7}) > 15
