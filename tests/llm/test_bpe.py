import hashlib

import numpy as np
import pytest
from llm_data import documents, with_clashes

from postlens.llm import bpe
from postlens.llm.queries import VOCABULARY, vocabulary

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
ODD = [
    None, "", "  ", "Σίσυφος ΑΣ İstanbul ß ẞ", "<|endoftext|> hi<|startoftext|>", "é é x\x85w\xa0​q",
    " 　a b", "日本語テキスト 한국어 😀👍🏽", "it's I'LL can't 'S", "123 4567 ½ ² ①", "a" * 3000, "ab" * 300,
    "\x00\x01 \x7f", "don't<|endoftext|>", "﻿x", "ạ́", "<|ENDOFTEXT|>", "x\x1cy", "heed. heed, heed", "aaaaaaa aaaa",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(P.path(VOCABULARY))


@pytest.mark.parametrize("segment", [8, 1 << 20])
def test_ids_and_decoding_are_those_of_the_library(spark, library, duck, monkeypatch, segment):
    monkeypatch.setattr(bpe, "SEGMENT", segment)
    texts = ODD + [r[0] for r in duck.execute("SELECT text FROM documents ORDER BY doc_id LIMIT 60").fetchall()]
    docs = with_clashes(documents(spark, texts), "ids", "n_tokens")
    for r in bpe.encode_documents(docs, vocabulary()).collect():
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        assert r.ids == ids, texts[r.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_empty_table_null_and_repeated_ids(spark):
    assert bpe.encode_documents(documents(spark, []), vocabulary()).collect() == []
    rows = bpe.encode_documents(documents(spark, ["to", None, "to"], [None, 1, 1]), vocabulary()).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in rows) == [("1", 0), ("1", 1), ("None", 1)]


def test_memory_is_bounded_in_bytes_and_ends_with_the_task(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_BYTES", 5 * bpe.STRING_BYTES)
    monkeypatch.setattr(bpe, "FLUSH_STRINGS", 4)
    encoder = bpe.Encoder(bpe.Vocabulary(vocabulary()))
    for text in ("one two three four", "five six seven", "one two eight nine ten eleven twelve"):
        ids = np.concatenate([x for _, x in encoder.encode([text])]).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert encoder.held <= bpe.KNOWN_BYTES
    # One very long string is forgotten as soon as its text is done.
    long = "xyzzy" * 200_000
    assert sum(len(x) for _, x in encoder.encode([long, "one"])) > 200_000
    assert encoder.held == 0 and not encoder.place
    # No worker keeps an encoder: what a later task finds there are modules only.
    bpe.encode_documents(documents(spark, ["one two"] * 50), vocabulary()).collect()

    def left(batches):
        import gc
        import sys

        import pyarrow as pa

        for batch in batches:
            kept = sum(type(x).__name__ == "Encoder" for x in gc.get_objects()) + sum("postlens_bpe" in m for m in sys.modules)
            yield pa.RecordBatch.from_arrays([pa.array([kept] * batch.num_rows)], ["kept"])

    assert {r.kept for r in spark.range(100).repartition(8).mapInArrow(left, "kept long").collect()} == {0}


def test_merges_that_use_a_symbol_before_it_is_made_are_refused():
    said = vocabulary()
    at = said.index('"merges"')
    import json

    model = json.loads(said)
    model["model"]["merges"].reverse()
    with pytest.raises(ValueError):
        bpe.Vocabulary(json.dumps(model))
    assert at > 0
