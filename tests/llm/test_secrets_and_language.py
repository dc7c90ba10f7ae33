import hashlib
import math
import random
import re
import string
import unicodedata
import zlib
from collections import Counter

from llm_data import documents, with_clashes, words
from pyspark.sql import functions as F

from postlens.llm import language_id, queries, secrets

PATTERNS = {
    "assign": re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"access": 18, "hex": 16}


def base_spans(text):
    spans = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text):
            if (len(m[2]) >= 12) if kind == "assign" else (len(m[0]) >= LEAST[kind]):
                spans.append((m.start(), no, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


SECRETS = [
    None, "", "password = 'abcdefghijkl'", "PassWd:abcdefghijk", "token=password: abcdefghijklmnopqr", "x token==abcdefghijklm",
    "API_KEY: ABCDEFGH1234 apikey=\"zzzzzzzzzzzzzz\"", "é🙂 secret=0123456789abcdef0123", "AKIA" + "A" * 13, "AKIA" + "B7" * 9,
    "AKIAAKIA" + "C" * 10, "0123456789abcde", "0123456789abcdef", "g0123456789abcdefg0123456789abcdef01", "ſecret=abcdefghijklmn",
    "secret='tokentoken=abcdefghijklmno'", "password\n=abcdefghijklmn", "secret  :  \"a.b/c+d=e_f-g\"",
]


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(3)
    parts = ["secret", "token", "=", ":", " ", "'", "AKIA", "0123456789abcdef", "Q9Z8", "abcdefgh", "é", "_", "passwd", "API", "_key"]
    texts = SECRETS + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(300)]
    docs = with_clashes(documents(spark, texts), "row", "hex", "assign", "spans").repartition(3)
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = base_spans(text or "")
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest(), text
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex")]
        assert [x for x in r.spans.split(",") if x and not x.startswith("markov")] == base


def test_markov_models_tell_random_strings_from_identifiers(spark):
    rng = random.Random(8)
    signs = string.ascii_letters + string.digits
    random_one = lambda n: "".join(rng.choice(signs) for _ in range(n))
    plain = ["customer_address_line", "maximum_retry_interval", "internationalization", "configuration.settings.value"]
    short = ["customer", "address_line", "maximum", "retry", "interval", "national", "settings", "configure", "values"]
    texts = [f"password={random_one(24)} and {rng.choice(plain)} of {rng.choice(short)} {rng.choice(short)}" for _ in range(150)]
    hidden = random_one(40)
    texts += [f"see {hidden} there", " ".join(plain)]
    rows = {r.doc_id: r for r in secrets.find_secrets(documents(spark, texts)).collect()}
    assert rows[150].spans == f"markov:4:{4 + len(hidden)}"
    assert rows[151].spans == ""


def brute_markov(texts, min_run=20, threshold=1.0, min_piece=12, evidence=12.0):
    """Spans (start, end) that the models add in each text; every text is in the sample."""
    spans = [[], *[[] for _ in texts[1:]]]
    rests, counts = [], {"random": Counter(), "identifier": Counter()}
    for i, text in enumerate(texts):
        rest = text
        for kind, pattern in PATTERNS.items():
            ok = lambda m: (len(m[2]) >= 12) if kind == "assign" else len(m[0]) >= LEAST[kind]  # noqa: B023, E731
            for m in filter(ok, pattern.finditer(text)):
                spans[i].append((m.start(), m.end()))
                counts["random"].update(zip(m[2] if kind == "assign" else m[0], (m[2] if kind == "assign" else m[0])[1:]))
            rest = pattern.sub(lambda m: " " * len(m[0]) if ok(m) else m[0], rest)
        rests.append(rest)
        for word in re.findall(r"[A-Za-z_][A-Za-z0-9_.-]{5,}", rest):
            if len(word) < min_piece:
                counts["identifier"].update(zip(word, word[1:]))
    signs = secrets.ALPHABET

    def log(label, a, b):
        seen = lambda y: sum(counts[label][x, y] for x in signs) + 0.5
        share = seen(b) / sum(map(seen, signs))
        return math.log((counts[label][a, b] + 20 * share) / (sum(counts[label][a, y] for y in signs) + 20))

    ratios = {}

    def total(value):
        for pair in zip(value, value[1:]):
            if pair not in ratios:
                ratios[pair] = log("random", *pair) - log("identifier", *pair)
        return sum(ratios[p] for p in zip(value, value[1:]))

    for base, rest in zip(spans, rests):
        runs = [m.span() for m in re.finditer(r"[A-Za-z0-9+/_.=-]{%d,}" % min_run, rest) if total(m[0]) / (len(m[0]) - 1) > threshold]
        pieces = [m.span() for m in re.finditer(r"[A-Za-z0-9+]{%d,}" % min_piece, rest) if total(m[0]) > evidence]
        pieces = [(a, b) for a, b in pieces if not any(a < d and c < b for c, d in runs)]
        yield sorted((a, b) for a, b in runs + pieces if not any(a < d and c < b for c, d in base))


def test_markov_spans_equal_brute_force(spark):
    rng = random.Random(21)
    signs = string.ascii_letters + string.digits
    drawn = lambda n: "".join(rng.choice(signs) for _ in range(n))
    plain = ["customer_address", "maximum.retry", "internationalization", "settings", "configuration-value", "interval", "opt/local/share"]
    texts = []
    for _ in range(120):
        parts = [rng.choice(plain) for _ in range(6)]
        parts += rng.choice([[f"password={drawn(24)}"], [f"token: {drawn(14)}é{drawn(16)}"], [f"secret={drawn(9)}"], ["0123456789abcdef" + drawn(20)]])
        parts += rng.choice([[drawn(rng.randrange(8, 30))], [f"/home/{plain[0]}/{drawn(15)}/end"], [f"{drawn(16)}-{drawn(5)}"], ["🙂" + drawn(13)], []])
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    texts += ["", "AKIA" + "B7" * 9 + "/" + drawn(18), "api_key=" + drawn(20) + ":" + drawn(20)]
    want = list(brute_markov(texts))
    rows = {r.doc_id: r for r in secrets.find_secrets(documents(spark, texts).repartition(4)).collect()}
    for i, spans in enumerate(want):
        got = sorted(tuple(map(int, x.split(":")[1:])) for x in rows[i].spans.split(",") if x.startswith("markov"))
        assert got == spans, texts[i]
        assert rows[i].n_markov == len(spans)
    found = sum(map(len, want))
    assert found > 60 and any(b - a < 20 for spans in want for a, b in spans)


def test_random_strings_in_paths_and_beside_base_spans(spark):
    rng = random.Random(4)
    signs = string.ascii_letters + string.digits
    drawn = lambda n: "".join(rng.choice(signs) for _ in range(n))
    short = ["customer", "address_line", "maximum", "retry", "interval", "national", "settings", "configure", "values"]
    texts = [f"password={drawn(24)} of {rng.choice(short)} {rng.choice(short)}" for _ in range(150)]
    path = "/usr/local/configuration/settings/customer/national/"
    end, beside, small = drawn(16), drawn(18), drawn(13)
    texts += [path + end, f"0123456789abcdef/{beside} x", f"see {small}", path + "internationalization"]
    rows = {r.doc_id: r.spans for r in secrets.find_secrets(documents(spark, texts)).collect()}
    assert rows[150] == f"markov:{len(path)}:{len(path) + 16}"
    assert rows[151] == "hex:0:16,markov:17:35"
    assert rows[152] == "markov:4:17"
    assert rows[153] == ""


def test_secrets_edges(spark):
    assert secrets.find_secrets(documents(spark, [])).collect() == []
    rows = secrets.find_secrets(documents(spark, ["token=abcdefghijklmnop"] * 2 + [None], [None, None, 1])).collect()
    assert sorted((str(r.doc_id), r.n_assign) for r in rows) == [("1", 0), ("None", 1), ("None", 1)]


def test_language_accuracy_on_held_out_rows(spark, duck):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language_id.held_out()
    model = language_id.train(docs, ~held, F.col("doc_id"))
    assert model.languages == ["de", "en", "es", "fr"]
    rows = language_id.predict(docs.withColumn("held", held), model).filter("held").collect()
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = language_id.held_out()
    changed = docs.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang")))
    changed = changed.withColumn("text", F.when(held, "zzz").otherwise(F.col("text")))
    a, b = (language_id.train(d, ~held, F.col("doc_id")) for d in (docs, changed))
    assert a.languages == b.languages and (a.log_prob == b.log_prob).all() and (a.log_prior == b.log_prior).all()


def test_scores_of_long_texts_equal_plain_sums(spark, monkeypatch):
    docs = documents(spark, ["der die das und ist", "the and of is", "le la les est"] * 40, langs=["de", "en", "fr"] * 40)
    model = language_id.train(docs, F.lit(True), F.col("doc_id"), sample_per_language=10**6)
    texts = ["the and " * 50, "die und", "🙂 le"]
    whole = language_id._scores(texts, model)
    monkeypatch.setattr(language_id, "SEGMENT", 16)
    assert abs(language_id._scores(texts, model) - whole).max() < 1e-6


def bayes(learned, texts):
    """Brute force: (language, posterior) of each text, from all learned (text, language)."""
    def buckets(text):
        points = [ord(c) for c in f" {text.lower()} "]
        for n in range(1, 4):
            for i in range(len(points) - n + 1):
                code = sum((p + 1) * int(f) for p, f in zip(points[i : i + n], language_id._FACTORS))
                yield (code * 0xD6E8FEB86659FD93 % 2**64) >> (64 - language_id.BUCKET_BITS)

    counts = {}
    for text, lang in learned:
        counts.setdefault(lang, Counter()).update(buckets(text))
    total = {lang: sum(c.values()) + 0.1 * 2**language_id.BUCKET_BITS for lang, c in counts.items()}
    prior = Counter(lang for _, lang in learned)
    for text in texts:
        if not any(unicodedata.category(c)[0] == "L" for c in text or ""):
            yield "und", 0.0
            continue
        log = {
            lang: math.log(prior[lang] / len(learned)) + sum(math.log((counts[lang][b] + 0.1) / total[lang]) for b in buckets(text))
            for lang in counts
        }
        best = max(log.values())
        yield min(lang for lang in log if log[lang] == best), 1 / sum(math.exp(x - best) for x in log.values())


def test_registered_language_query_equals_brute_force(spark, sf_dir):
    rows = [r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows}
    learned = [(r.text or "", r.lang) for r in rows if not held[r.doc_id] and r.lang is not None]
    assert len(learned) < 4000  # so that the sample of every language is all of its rows
    got = {r.doc_id: r for r in queries.op8(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r, (lang, score) in zip(rows, bayes(learned, [r.text for r in rows])):
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held[r.doc_id], lang), r.doc_id
        assert abs(got[r.doc_id].score - score) < 1e-3, r.doc_id


def test_letters_are_unicode_letters(spark):
    model = language_id.train(documents(spark, ["the and of"]), F.lit(True), F.col("doc_id"))
    texts = ["½ ²", "① 12", "Ⅷ", "_", "ª", "中", "1a"]
    got = {r.doc_id: r.lang_pred for r in language_id.predict(documents(spark, texts), model).collect()}
    assert got == {0: "und", 1: "und", 2: "und", 3: "und", 4: "en", 5: "en", 6: "en"}


def test_more_languages_than_are_learned(spark, monkeypatch):
    texts, langs = ["the and of"] * 1300, [f"l{i % 600:03d}" for i in range(1200)] + ["l599"] * 100
    docs = documents(spark, texts, langs=langs)
    model = language_id.train(docs, F.lit(True), F.col("doc_id"))
    assert model.languages == [f"l{i:03d}" for i in range(511)] + ["l599"]
    assert model.log_prob.shape == (1 << language_id.BUCKET_BITS, 512)
    assert {r.lang_pred for r in language_id.predict(docs, model).collect()} == {"l599"}


def test_language_edges(spark):
    docs = documents(spark, [None, "", "123 !", "the and of"], langs=[None, "en", "en", "en"])
    docs = with_clashes(docs, "lang_pred", "score")
    model = language_id.train(docs, F.lit(True), F.col("doc_id"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, model).collect()}
    assert got == {0: ("und", 0.0), 1: ("und", 0.0), 2: ("und", 0.0), 3: ("en", 1.0)}
    empty = documents(spark, [])
    none = language_id.train(empty, F.lit(True), F.col("doc_id"))
    assert language_id.predict(empty, none).collect() == []
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
