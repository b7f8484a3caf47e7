import random
from collections import Counter

import numpy as np
import pytest

from tablewright.llm import bwt


def strings(rnd, n=40):
    pool = [bytes(rnd.choice([0, 97, 98, 255]) for _ in range(rnd.randrange(60))) for _ in range(6)]
    return [b"".join(rnd.choice(pool) for _ in range(rnd.randrange(5))) for _ in range(n)]


def test_transform_is_that_of_sorted_suffixes():
    rnd = random.Random(2)
    for _ in range(20):
        some = strings(rnd, 7)
        s = bwt.shard_bwt(some)
        key = lambda p: [x + 1 for x in some[p[0]][p[1]:]] + [0, p[0]]
        every = sorted(((i, j) for i, x in enumerate(some) for j in range(len(x) + 1)), key=key)
        assert list(zip(s.text.tolist(), s.place.tolist())) == every
        assert s.bwt.tolist() == [some[i][j - 1] + 1 if j else 0 for i, j in every]


@pytest.mark.parametrize("length", [1, 3, 4, 5, 16, 20, 33])
@pytest.mark.parametrize("shards", [1, 2, 5])
def test_repeated_places(length, shards):
    rnd = random.Random(length * 10 + shards)
    for _ in range(5):
        some = strings(rnd)
        n = Counter(x[j:j + length] for x in some for j in range(len(x) - length + 1))
        want = [[j for j in range(len(x) - length + 1) if n[x[j:j + length]] > 1] for x in some]
        assert [p.tolist() for p in bwt.repeated_places(some, length, shards)] == want


def test_nothing():
    assert [p.tolist() for p in bwt.repeated_places([b"", b"", b"abc"], 2)] == [[], [], []]
    assert np.array_equal(bwt.shard_bwt([b""]).bwt, [0])
