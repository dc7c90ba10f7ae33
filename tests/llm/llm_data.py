"""Small hand-made tables with the awkward cases."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, langs=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [
        (i, t, (langs or ["en"] * len(texts))[k], (sources or ["src0"] * len(texts))[k], len(t or ""))
        for k, (i, t) in enumerate(zip(ids, texts))
    ]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def with_clashes(df, *names):
    """Extra columns, named as an operator may name its own."""
    for name in names:
        if name not in df.columns:
            df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary):x}" for _ in range(n))


def near_copies(seed=5, groups=6, size=6, n=120):
    """Texts in groups whose members differ in a few words, and single ones."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = words(rng, n, 10**6).split()
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(n)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own))
        texts.append(words(rng, n, 10**6))
    return texts
