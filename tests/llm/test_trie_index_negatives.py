import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_data import documents, with_clashes
from pyspark.sql import functions as F

from postlens.llm import conversation_trie, hard_negatives, phrase_index, queries

# --- conversation trie ----------------------------------------------------


def trie_of(whole):
    """Brute force over {conversation: [(role, text), ...]}."""
    members = defaultdict(list)
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    out = set()
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        inner = {n[:-1] for n in members if n}
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        out.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(n) == len(node) + 1 for n in below), sum(n not in inner for n in below),
            sum((len(members[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


CONV_SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(seed=3, n=60):
    rng = random.Random(seed)
    convs = {}
    for c in [*range(-12, n), 10**12, 10**12 + 1]:
        if c % 7 == 3:
            continue
        length = 40 if c == 5 else rng.choice([0, 1, 2, 3, 9, 12])
        convs[c] = [(rng.choice(["user", "assistant", ""]), rng.choice(["", "a", "bé", "a" * 50])) for _ in range(length)]
    for c in (20, 21, 22, 23, 24, 30, 31, 32):
        convs[c] = [("user", "hi"), ("assistant", "ho")]
    return {c: t for c, t in convs.items() if t}


def conversation_rows(convs, seed=1):
    """Shuffled, with gaps between turns and empty values as nulls here and there."""
    rng = random.Random(seed)
    rows = []
    for c, turns in convs.items():
        for i, (role, text) in enumerate(turns):
            turn = None if i == 0 and c % 2 else 3 * i - 5
            rows.append((c, turn, role or rng.choice([None, ""]), text or rng.choice([None, ""])))
    rng.shuffle(rows)
    return rows


def trie_query(spark, rows, tmp_path):
    df = with_clashes(spark.createDataFrame(rows, CONV_SCHEMA).repartition(5), "node", "depth", "place", "digest", "part")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    return queries.op11(spark, str(tmp_path))


@pytest.mark.parametrize("ids", [2, 8192])
def test_trie_equals_brute_force(spark, rows, tmp_path, monkeypatch, ids):
    monkeypatch.setattr(conversation_trie, "PIECE_IDS", ids)
    convs = conversations()
    got = rows(trie_query(spark, [*conversation_rows(convs), (None, 0, "user", "no id")], tmp_path))
    assert len(got) == len(set(got)) and set(got) == trie_of(rebuilt(convs))


def test_trie_of_conversations_as_they_are(spark, rows):
    convs = {1: [("u", "x"), ("a", "y")], 2: [("u", "x")], 3: [("u", "x"), ("a", "y")], 9: [("u", "x"), ("a", "z"), ("u", "x")]}
    flat = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    chained = conversation_trie.chains(conversation_trie.as_they_are(conversation_trie.turns(spark.createDataFrame(flat, CONV_SCHEMA))))
    assert set(rows(conversation_trie.trie(chained))) == trie_of(convs)
    whole = conversation_trie.sequences(chained).select("seq", "weight", "total", "leaf")
    assert rows(whole) == [(1, 2, 2, True), (2, 1, 1, False), (9, 1, 3, True)]


def test_trie_role_and_text_do_not_run_together(spark):
    df = spark.createDataFrame([(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, "1:a", "")], CONV_SCHEMA)
    assert conversation_trie.turns(df).select("digest").distinct().count() == 3


def test_trie_repeated_and_tied_rows(spark, rows):
    flat = [(1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "a", "y"), (6, 0, "a", "y"), (6, 0, "u", "x"), (6, 0, "u", "x")]
    got = [trie for trie in (
        rows(conversation_trie.trie(conversation_trie.chains(conversation_trie.as_they_are(conversation_trie.turns(spark.createDataFrame(f, CONV_SCHEMA))))))
        for f in (flat, flat[::-1])
    )]
    assert got[0] == got[1] and [g[:4] for g in got[0]] == [(1, 0, None, 2), (1, 1, 1, 2), (1, 2, 1, 2), (1, 3, 1, 2)]


def test_trie_of_no_rows_and_of_a_very_long_conversation(spark, tmp_path):
    assert trie_query(spark, [], tmp_path / "none").collect() == []
    long = [(0, i, "user", "x" * (i % 3)) for i in range(30_000)]
    got = trie_query(spark, [*long, (1, 0, "user", "y" * 100_000)], tmp_path / "long")
    assert got.agg(F.max("depth"), F.max("n_convs")).first() == (30_000, 2)


# --- phrase index ---------------------------------------------------------

ITEM_SCHEMA = "item_id long, text string"


def words_of(text):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def windows_of(items, size):
    out = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        if item is not None and w:
            for i in range(max(1, len(w) - size + 1)):
                out[tuple(w[i : i + size])].add(item)
    return out


def contaminated(texts, items, size):
    windows = windows_of(items, size)
    out = []
    for i, text in enumerate(texts):
        w, hit, found = words_of(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[at : at + n])):
                    hit.update(range(at, at + n))
                    found |= owners
        listed = ",".join(sorted(map(str, found)))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return out


def corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "é", "x1", "日本", "ab", "q r", "'s"]
    spell = lambda n: rng.choice([" ", "\n", "; "]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, spell(rng.choice([1, 2, 4, 5, 9, 14]))) for i in range(25)]
    items += [(3, "ab ab ab"), (None, "the"), (40, None), (41, ""), (42, "?!"), (11, "never seen anywhere"), (43, "THE é the É é")]
    texts = [spell(rng.randrange(80)) for _ in range(60)] + [None, "", " - ", "the", "ab", "ab ab ab ab ab ab"]
    texts += [f"{spell(20)} {t} {spell(3)}" for _, t in items if t]
    return texts, items


@pytest.mark.parametrize(("chunk", "slot", "size"), [(1 << 23, 1 << 16, 4), (300, 3, 4), (1, 1, 6)])
def test_contamination_equals_brute_force(spark, rows, chunk, slot, size):
    texts, items = corpus()
    docs = with_clashes(documents(spark, texts).repartition(3), "chunk", "doc", "term", "n", "window", "first")
    bench = with_clashes(spark.createDataFrame(items, ITEM_SCHEMA), "window", "terms", "w")
    got = rows(phrase_index.contamination(docs, bench, size, chunk_bytes=chunk, slot_windows=slot))
    assert got == sorted(contaminated(texts, items, size), key=repr)


def test_contamination_of_ids_that_repeat_or_are_null_and_of_no_rows(spark, rows):
    docs = documents(spark, ["a b", "a", "b"], [None, 5, 5])
    bench = spark.createDataFrame([(1, "A")], ITEM_SCHEMA)
    assert [r[:3] for r in rows(phrase_index.contamination(docs, bench))] == [(5, 1, 0), (5, 1, 1), (None, 2, 1)]
    none = spark.createDataFrame([], ITEM_SCHEMA)
    assert [r[2:4] for r in rows(phrase_index.contamination(docs, none))] == [(0, 0)] * 3
    assert phrase_index.contamination(documents(spark, []), bench).collect() == []


def test_index_holds_every_place_of_every_word(spark):
    texts, _ = corpus()
    index = phrase_index.build_index(documents(spark, texts).repartition(2), chunk_bytes=500)
    chunks = defaultdict(dict)
    for r in index.collect():
        chunks[r.chunk][r.term] = r
    seen = {}
    for lists in chunks.values():
        head = lists.pop(None)
        starts = np.r_[0, np.cumsum(np.array(head.sizes) + 1)]
        for i, doc in enumerate(head.docs):
            seen[doc] = [None] * head.sizes[i]
        for term, r in lists.items():
            places = phrase_index.places_of(r.places)
            assert len(places) == r.n and (np.diff(places) > 0).all()
            for p in places:
                d = np.searchsorted(starts, p, "right") - 1
                seen[head.docs[d]][p - starts[d]] = term
    assert seen == {i: words_of(t) for i, t in enumerate(texts)}


def near(texts, items, size, within):
    out = set()
    for i, text in enumerate(texts):
        w = words_of(text)
        for window, owners in windows_of(items, size).items():
            need = set(window)
            spans = [(a, b) for a in range(len(w)) for b in range(a, min(len(w), a + within)) if need <= set(w[a : b + 1])]
            smallest = [(a, b) for a, b in spans if not any((c, d) != (a, b) and a <= c and d <= b for c, d in spans)]
            out |= {(i, o, a, b) for a, b in smallest for o in owners}
    return out


def test_proximity_equals_brute_force(spark):
    texts, items = corpus(8)
    texts, items = [t for t in texts if len(words_of(t)) < 50], items[::2]
    index = phrase_index.build_index(documents(spark, texts), chunk_bytes=400)
    windows, owners = phrase_index.item_windows(spark.createDataFrame(items, ITEM_SCHEMA), 4)
    found = phrase_index.proximity_matches(index, windows, 7, slot_windows=5).join(owners, "window")
    found = found.join(phrase_index.documents_of(index), ["chunk", "doc"])
    expected = near(texts, items, 4, 7)
    assert {(r.doc_id, r.item_id, r.first, r.last) for r in found.collect()} == expected
    report = phrase_index.near_matches(documents(spark, texts), spark.createDataFrame(items, ITEM_SCHEMA), 4, 7)
    per = defaultdict(list)
    for d, i, a, b in expected:
        per[d, i].append((a, b))
    assert {tuple(r) for r in report.collect()} == {(*k, len(v), *min(v)) for k, v in per.items()}


def test_phrase_matches_name_every_occurrence(spark):
    index = phrase_index.build_index(documents(spark, ["a b a b a", "b a"]))
    windows, _ = phrase_index.item_windows(spark.createDataFrame([(1, "a b")], ITEM_SCHEMA), 10)
    found = phrase_index.phrase_matches(index, windows).join(phrase_index.documents_of(index), ["chunk", "doc"])
    assert sorted((r.doc_id, r.first, r.last) for r in found.collect()) == [(0, 0, 1), (0, 2, 3)]


# --- hard negatives -------------------------------------------------------

VECTOR_SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_strassen_equals_the_plain_product(leaf):
    rng = np.random.default_rng(leaf)
    for m, n, k in [(1, 1, 1), (5, 7, 3), (8, 8, 8), (33, 65, 17), (70, 40, 64)]:
        a, b = rng.integers(-(2**40), 2**40, (m, k)), rng.integers(-(2**17), 2**17, (n, k))
        exact = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert hard_negatives.strassen(a, b, leaf).tolist() == exact


def test_products_are_taken_in_doubles_where_that_is_exact():
    rng = np.random.default_rng(4)
    side = lambda n, most: {"vectors": rng.integers(-most, most + 1, (n, 64))}
    for most, kind in ((256, np.float64), (2**21, np.float64), (2**25, np.int64), (2**40, np.int64)):
        one, two = side(70, most), side(90, most)
        a, b = hard_negatives._factors(one, two)
        exact = one["vectors"].astype(object) @ two["vectors"].astype(object).T
        assert a.dtype == b.dtype == kind and (most > 2**30 or (hard_negatives.strassen(a, b) == exact).all())


def test_blocks_grow_with_the_tables_so_that_rows_are_copied_to_few_cells(spark, monkeypatch):
    """Blocks of a fixed size copy a row once for so many of them: the copies were the square of the table."""
    cells = []
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 2)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_BLOCK", 3)
    monkeypatch.setattr(hard_negatives, "_cells", lambda a, n, c, m, plain=hard_negatives._cells: cells.append((n, m)) or plain(a, n, c, m))
    rows = [(i, [float(i % 9), float(i % 5)], i % 3) for i in range(600)]
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(hard_negatives.quantised(spark.createDataFrame(rows, VECTOR_SCHEMA), label), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r)[:6] for r in got.collect()) == sorted(mined(rows))
    assert cells == [(hard_negatives.ANCHOR_BLOCKS, 60)] * 2


def test_heaps_merge_to_the_same_whatever_the_order():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 6, (9, 200)), rng.integers(0, 50, 200)
    scores[rng.random(scores.shape) < 0.3] = hard_negatives.NONE
    got = []
    for cuts in ([200], [1, 50, 200], [100, 200]):
        heaps, at = hard_negatives.Heaps(9, 4), 0
        for cut in cuts:
            heaps.add(0, scores[:, at:cut], ids[at:cut], np.arange(at, cut))
            at = cut
        got.append([x.tolist() for x in heaps.entries()])
    back = hard_negatives.Heaps(9, 4)
    for i in range(199, -1, -1):
        back.add(0, scores[:, i : i + 1], ids[i : i + 1], np.array([i]))
    got.append([x.tolist() for x in back.entries()])
    assert all(g == got[0] for g in got)


def mined(vectors, of=100, low=50, high=95):
    rows = []
    for i, x, label in vectors:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        rows.append((i, [math.floor(256 * float(np.float32(v))) for v in x], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (i, q, label) in enumerate(rows):
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), j, lab, b) for b, (j, p, lab) in enumerate(rows))
        for s, j, _, _ in [r for r in scored if r[2] == label and r[3] != a][:5]:
            within = [(t, k) for t, k, lab, _ in scored if lab != label and low * -s <= of * -t <= high * -s]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(within[:3], 1)]
    return sorted(out, key=repr)


def vectors(seed=2, n=400):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 1) for _ in range(13)] for _ in range(6)]
    out = []
    for i in range(n):
        label = rng.randrange(6)
        x = [round(v + rng.gauss(0, 0.8), 2) for v in base[label]]
        out.append((i, x[: rng.choice([13, 13, 13, 5, 0])], label))
    out += [(1000 + i, base[0], rng.randrange(3)) for i in range(0, 120, 2)]  # equal vectors, many ties
    out += [(350, base[0], 0), (350, base[0], 0), (350, base[1], 1), (401, None, 1), (402, [1.0, None], 1), (403, [float("nan")], 1)]
    out += [(404, [float("-inf")], 2), (405, [1.0], None), (None, [1.0], 2), (450, [0.0] * 13, 1), (500, [-v for v in base[2]], 2)]
    return out


@pytest.mark.parametrize("blocks", [(1024, 4096), (3, 7)])
def test_hard_negatives_equal_brute_force(spark, rows, monkeypatch, blocks):
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    df = with_clashes(spark.createDataFrame(vectors(), VECTOR_SCHEMA).repartition(4), "uid", "q", "block", "bars", "score")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(hard_negatives.quantised(df, label), F.col("vec_id") % 50 == 0, anchor_block=blocks[0], candidate_block=blocks[1])
    assert rows(got.drop("anchor_row", "positive_row", "negative_row")) == mined(vectors())


def test_hard_negatives_of_no_rows_one_label_and_huge_components(spark, tmp_path):
    every = lambda data: hard_negatives.mine(hard_negatives.quantised(spark.createDataFrame(data, VECTOR_SCHEMA)), F.col("vec_id") % 50 == 0).collect()
    assert every([]) == [] and every([(0, [1.0], 1), (50, [2.0], 1)]) == []
    got = every([(0, [1e30, 1.0], 1), (1, [1e30, 1.0], 1), (2, [1e6, 0.0], 2)])
    most = math.isqrt((2**63 - 1) // 2)
    assert all(0 < r.positive_score < 2**63 for r in got) and most**2 * 2 < 2**63


def test_registered_query_of_hard_negatives(spark, rows, tmp_path):
    spark.createDataFrame(vectors(), VECTOR_SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert rows(queries.op13(spark, str(tmp_path))) == mined(vectors())
