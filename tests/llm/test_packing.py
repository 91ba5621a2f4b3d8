"""Window counts of blocks: the least that differencing fits, whatever was read before."""

import random

from sluice.llm import packing


def fits(sizes, k):
    return all(sum(sizes[i] for i in w) <= packing.CAPACITY for w in packing.differencing(sizes, k))


def test_blocks_do_not_depend_on_the_last(spark):
    texts = ["word " * 600] * 64 + ["word " * 100] * 64
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, block_pieces=64).collect()
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    short = [r for r in rows if r.doc_id >= 64]
    sizes = [r.length for r in short]
    assert max(sizes) < packing.CAPACITY // 8
    used = len({r.sequence_id for r in short})
    assert used == next(k for k in range(1, 65) if fits(sizes, k))


def test_window_counts():
    draw = random.Random(5)
    cases = [[draw.randint(1, 1024) for _ in range(n)] for n in (1, 2, 7, 60, 200)]
    cases += [[600] * 50, [1024] * 3, [340 + n % 20 for n in range(90)], [400, 700] * 30, [600] * 20 + [100] * 40]
    for sizes in cases:
        found = packing.windows(sizes)
        assert sorted(i for w in found for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= packing.CAPACITY for w in found)
        least = max(-(-sum(sizes) // packing.CAPACITY), sum(2 * n > packing.CAPACITY for n in sizes))
        assert len(found) == least or not fits(sizes, len(found) - 1)
