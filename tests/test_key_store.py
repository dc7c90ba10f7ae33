"""Keys in buckets with filters next to them."""

import numpy as np

from postlens.streaming import key_store
from postlens.streaming.key_store import KeyStore


def test_a_filter_passes_all_it_holds_and_little_else():
    rng = np.random.default_rng(3)
    held, other = rng.integers(-(2**63), 2**63 - 1, 5000), rng.integers(-(2**63), 2**63 - 1, 200_000)
    bits = key_store.bloom(held)
    assert len(bits) == 24 * 5000 // 8
    assert key_store.passes(bits, held).all() and key_store.passes(bits, other).mean() < 1e-4
    assert key_store.passes(key_store.bloom(held[:1]), held[:1]).all()
    # Hashes that share their bucket's low bits are told apart all the same.
    low = (held << 4).astype(np.int64)
    assert key_store.passes(key_store.bloom(low[:2500]), low[2500:]).mean() < 1e-2


def keys(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "post_id long")


def unseen(store, spark, numbers, before):
    return sorted(r.post_id for r in store.unseen(keys(spark, numbers), before).collect())


def test_folders_opened_do_not_grow_with_batches_without_repeats(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path), "post_id", buckets=4)
    assert store.matching(keys(spark, [1]), 0) == [] and unseen(store, spark, [1, 2], 0) == [1, 2]
    opened = []
    for batch in range(6):
        new = range(100 * batch, 100 * batch + 100)
        opened.append(len(store.matching(keys(spark, new), batch)))
        assert unseen(store, spark, new, batch) == list(new)
        store.store(keys(spark, new), batch)
    assert opened == [0] * 6
    # One repeat opens one folder of the batch that has it, however many there are.
    assert [b for b, _ in store.matching(keys(spark, [*range(900, 960), 205]), 6)] == [2]
    assert unseen(store, spark, [205, 900, 0, 599], 6) == [900]


def test_a_batch_does_not_see_itself_or_later_ones_and_is_replaced(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path), "post_id")
    store.store(keys(spark, [1, 1, 2, None]), 0)
    store.store(keys(spark, [3]), 1)
    assert unseen(store, spark, [1, 2, 3], 0) == [1, 2, 3]
    assert unseen(store, spark, [1, 2, 3], 1) == [3]
    store.store(keys(spark, [7]), 0)
    assert unseen(store, spark, [1, 2, 3, 7], 2) == [1, 2]
    store.store(keys(spark, []), 2)
    assert unseen(store, spark, [3, 8], 3) == [8]
