import hashlib
import math
import random
import re

import xxhash
from llm_data import documents, with_clashes, words
from pyspark.sql import functions as F

from postlens.llm import mixing, simhash


def fingerprint(text):
    total, votes = 0, [0] * 64
    for word in re.split(r"[\x20\x09-\x0D]+", text):
        weight = min(len(word), 12) ** 2
        total += weight
        h = xxhash.xxh64(word.encode(), seed=42).intdigest()
        for bit in range(64):
            votes[bit] += weight * (h >> bit & 1)
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > total)


def edited(text, following):
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def test_fingerprints_equal_brute_force(spark):
    rng = random.Random(2)
    texts = ["", None, "a", "a b c d", "🙂🙂🙂🙂🙂🙂", "one  two\tthree"] + [words(rng, rng.randrange(200)) for _ in range(40)]
    texts += [texts[10], texts[10], texts[11]]
    ids = [3 * i for i in range(len(texts))]
    docs = with_clashes(documents(spark, texts, ids), "h", "row", "bits", "v", "next_id").repartition(5)
    got = {r.doc_id: r for r in simhash.simhash(docs, query_step=10).collect()}
    assert len(got) == len(texts)
    plain = [t or "" for t in texts]
    bits = [fingerprint(t) for t in plain]
    for k, i in enumerate(ids):
        after = (k + 1) % len(ids)
        changed = edited(plain[k], plain[after])
        r = got[i]
        assert r.n_chars == len(plain[k])
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == f"{bits[k]:016x}"
        assert r.edited_fingerprint == f"{fingerprint(changed):016x}"
        assert r.near_edited == 1 - bin(bits[k] ^ fingerprint(changed)).count("1") / 64
        assert r.near_next == 1 - bin(bits[k] ^ bits[after]).count("1") / 64
        near = sum(bin(bits[k] ^ b).count("1") <= 3 for b in bits)
        assert r.n_near == (near if i % 10 == 0 else None)


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    values = base + [b ^ sum(1 << p for p in rng.sample(range(64), rng.randrange(1, 7))) for b in base for _ in range(8)]
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    found = spark.createDataFrame([(i, v) for i, v in enumerate(signed)], "doc_id long, bits long")
    for radius, blocks in ((1, 3), (3, 5), (5, 7)):
        got = {r.bits: r.n_near for r in simhash.near_counts(found, F.lit(True), radius, blocks).collect()}
        assert got == {s: sum(bin(v ^ w).count("1") <= radius for w in values) for s, v in zip(signed, values)}


def test_near_copies_are_named(spark):
    rng = random.Random(6)
    base = [words(rng, 150) for _ in range(6)]
    texts = [None, ""] + base + [f"{b} {words(rng, k)}" for b in base for k in (0, 1, 2, 5)] + [base[0]]
    ids = [None, *range(1, len(texts) - 1), 3]
    docs = with_clashes(documents(spark, texts, ids), "bits", "near_bits", "row", "q")
    pairs, members = simhash.near_copies(docs, query_step=3)
    bits = [fingerprint(t or "") for t in texts]
    assert sorted((r.fingerprint, str(r.doc_id)) for r in members.collect()) == sorted((f"{b:016x}", str(i)) for i, b in zip(ids, bits))
    near = lambda a, b: bin(a ^ b).count("1")
    expected = {(i, f"{a:016x}", f"{b:016x}", near(a, b)) for i, a in zip(ids, bits) if i is not None and i % 3 == 0 for b in bits if near(a, b) <= 3}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert any(d > 0 for *_, d in got)
    # Named by both tables: as many rows as the operator counts.
    named = pairs.join(members.withColumnsRenamed({"fingerprint": "near_fingerprint", "doc_id": "near_id"}), "near_fingerprint")
    counted = {(r.doc_id, r.fingerprint): r.n for r in named.groupBy("doc_id", "fingerprint").count().toDF("doc_id", "fingerprint", "n").collect()}
    rows = simhash.simhash(docs, query_step=3).filter("n_near IS NOT NULL").collect()
    assert counted == {(r.doc_id, r.fingerprint): r.n_near for r in rows}


def test_simhash_null_ids_single_rows_and_empty_tables(spark):
    assert simhash.simhash(documents(spark, [])).collect() == []
    [one] = simhash.simhash(documents(spark, ["abcd efgh"], [4])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcd efab").hexdigest()
    rows = simhash.simhash(documents(spark, ["abcd efgh", None, "x"], [None, None, 2])).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in rows) == [("2", 1), ("None", 0), ("None", 9)]
    assert {r.edited_sha256 for r in rows if r.n_chars == 9} == {hashlib.sha256(b"abcd efab").hexdigest()}


def test_rows_that_repeat_id_and_text(spark):
    rows = simhash.simhash(documents(spark, ["abcd efgh"] * 3, [1, 1, 1])).collect()
    assert len(rows) == 3 and {r.near_next for r in rows} == {1.0}


TARGETS = {"a": 3.0, "b": 1.0, "absent": 2.0}


def expected_copies(rows, targets, seed=17):
    counts = {}
    for _, source in rows:
        if source in targets:
            counts[source] = counts.get(source, 0) + 1
    whole = sum(targets[s] for s in counts)
    out = []
    for i, source in rows:
        n = 1
        if source in counts:
            rate = targets[source] / whole * sum(counts.values()) / counts[source]
            parts, n = max(1, math.ceil(rate / 32)), 0
            for j in range(parts):
                u = int(hashlib.md5(f"{seed}{f'/{j}' if j else ''}:{i}".encode()).hexdigest()[:13], 16) / 16**13
                n += sum(c <= u for c in mixing.poisson_cdf(rate / parts))
        out += [(i, k + 1) for k in range(n)]
    return sorted(out)


def test_mix_equals_brute_force(spark):
    rng = random.Random(9)
    sources = [rng.choice(["a", "b", "b", "b", "other", None]) for _ in range(600)]
    docs = with_clashes(documents(spark, ["t"] * 600, sources=sources), "_place", "u").repartition(4)
    mixed = mixing.mix(docs, TARGETS)
    assert mixed.columns == [*docs.columns, "copy"], mixed.columns
    rows = mixed.collect()
    assert sorted((r.doc_id, r.copy) for r in rows) == expected_copies(list(enumerate(sources)), TARGETS)
    share = sum(r.source == "a" for r in rows) / sum(r.source in ("a", "b") for r in rows)
    assert abs(share - 0.75) < 0.08
    ids = [r.doc_id for r in rows]
    assert sum(a > b for a, b in zip(ids, ids[1:])) > len(ids) / 4  # not in the order of the input


def test_mix_edges(spark):
    assert mixing.mix(documents(spark, []), TARGETS).collect() == []
    docs = documents(spark, ["x", None, "x"], [None, None, 1], sources=["z", None, "z"])
    assert mixing.mix(docs, TARGETS).count() == 3  # no targets: every row once
    clash = documents(spark, ["x"], sources=["z"]).withColumn("copy", F.lit("own"))
    assert [r.copy for r in mixing.mix(clash, TARGETS).collect()] == [1]


def test_one_row_against_many_has_a_short_plan_and_the_copies_of_the_sql(spark, duck):
    rows = 20_000
    docs = lambda n: spark.range(n).selectExpr("id AS doc_id", "'t' AS text", "if(id = 7, 'a', 'b') AS source")
    mixed = mixing.mix(docs(rows), {"a": 1.0, "b": 1.0})
    plan_size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    # A rate of 10 000 takes no longer plan than one of 1 000.
    assert plan_size(mixed) < 1.2 * plan_size(mixing.mix(docs(2_000), {"a": 1.0, "b": 1.0}))
    expected = expected_copies([(i, "a" if i == 7 else "b") for i in range(rows)], {"a": 1.0, "b": 1.0})
    got = sorted((r.doc_id, r.copy) for r in mixed.select("doc_id", "copy").collect())
    assert got == expected
    alone = [c for i, c in got if i == 7]
    assert len(alone) == max(alone) and abs(len(alone) - rows / 2) < 5 * math.sqrt(rows / 2)
    own = duck.cursor()
    own.execute(f"CREATE TEMP TABLE documents AS SELECT i AS doc_id, CASE WHEN i = 7 THEN 'a' ELSE 'b' END AS source FROM range({rows}) t(i)")
    sql = mixing.mix_sql({"a": 1.0, "b": 1.0})
    assert sorted(own.execute(f"SELECT doc_id, copy FROM ({sql})").fetchall()) == expected


def test_poisson_steps_have_the_rate_as_their_mean():
    for rate in (0.05, 0.9, 3.0, 40.0):
        steps = mixing.poisson_cdf(rate)
        assert abs(sum(1 - c for c in steps) - rate) < 1e-9
