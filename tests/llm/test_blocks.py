import time

import numpy as np

from heatledger.llm import blocks


def test_parts_are_equal_cuts_of_the_key_space():
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64))
    for parts, bits in ((1, 64), (7, 64), (4096, 64), ((1 << 31) - 1, 64), (7, 40), (1000, 40)):
        some = keys >> np.uint64(64 - bits)
        assert blocks.part_of(some, parts, bits).tolist() == [int(k) * parts >> bits for k in some]


def test_messages_hold_every_key_once():
    keys = np.sort(np.random.default_rng(2).integers(0, 1 << 64, 3000, dtype=np.uint64))
    counts = np.arange(3000) % 300
    for parts in (1, 50, 1_000_000):
        rows = blocks.messages(2, 9, keys, counts, parts)
        assert len({r[1] for r in rows}) == len(rows) and [r[1] for r in rows] == sorted(r[1] for r in rows)
        back = [blocks.unpacked(r[3]) for r in rows]
        assert np.array_equal(np.concatenate([b[0] for b in back]), keys) and np.array_equal(np.concatenate([b[1] for b in back]), counts)
    assert blocks.messages(0, 0, keys[:0], counts[:0], 5) == []


def test_work_follows_the_keys_not_the_parts():
    keys = np.sort(np.random.default_rng(3).integers(0, 1 << 64, 2000, dtype=np.uint64))
    took = []
    for parts in (4_000_000, (1 << 31) - 1):
        began = time.perf_counter()
        rows = blocks.messages(0, 0, keys, np.ones(2000, np.int64), parts)
        took.append(time.perf_counter() - began)
        assert len(rows) <= 2000
    assert max(took) < 1  # a loop over the parts takes minutes
