import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm import negatives
from tidelog.llm.negatives import Scores, mine, primes_for

SCHEMA = "vec_id long, embedding array<float>, label int, c string, rank string"


@settings(max_examples=50, deadline=None)
@given(st.integers(1, 200), st.sampled_from([1, 100, 2**10, 2**20, 2**25]), st.integers(0, 1000))
def test_scores_are_exact(d, largest, seed):
    pick = np.random.default_rng(seed)
    a = pick.integers(-largest, largest + 1, (7, d))
    b = pick.integers(-largest, largest + 1, (5, d))
    bound = largest * largest * d
    found = Scores(b, primes_for(bound)).of(a)
    assert found.tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]


def test_primes_cover_the_bound():
    for bound in (0, 1, 10**5, 2**40, 2**59):
        primes = primes_for(bound)
        assert math.prod(primes) > 2 * bound + 1 and len(set(primes)) == len(primes)
        assert all(all(p % k for k in range(2, p)) for p in primes)


def plain(rows, step=100):
    clean = set()
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    sizes = [len(r[2]) for r in clean]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    clean = [r for r in clean if len(r[2]) == d]
    out = []
    for i, label, v in clean:
        if i % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in clean if j != i)
        for s, p, _ in [r for r in scored if r[2] == label][:5]:
            fit = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s]
            # A window row of the same id and another label cannot be its own negative here.
            out += [(i, p, n + 1, j, -s, -t) for n, (t, j, _) in enumerate(fit[:10])]
    return sorted(out)


def found(spark, rows, step=100):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    result = mine(frame, label, F.col("vec_id") % step == 0)
    return sorted(tuple(r) for r in result.collect())


def vectors(seed, n, d=6, labels=3):
    pick = random.Random(seed)
    return [(i, [pick.gauss(0.2, 1) for _ in range(d)], pick.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed, monkeypatch):
    if seed:
        # Small blocks, so that rows and anchors of all labels are spread.
        for name, value in (("ROW_BLOCK", 20), ("ANCHOR_BLOCK", 3), ("LEAST_BLOCK", 10), ("LABEL_GROUPS", 2)):
            monkeypatch.setattr(negatives, name, value)
    rows = vectors(seed, 150)
    result = found(spark, rows, 10)
    assert result == plain(rows, 10) and result


def test_unusable_rows_ties_and_repeats(spark):
    rows = vectors(5, 80)
    rows += rows[:30]
    rows += [(200, [0.5] * 6, 1), (201, [0.5] * 6, 1), (202, [0.5] * 6, 2), (203, [0.5] * 6, 2), (300, [0.0] * 6, 0)]
    rows += [(400, None, 1), (401, [1.0] * 6, None), (None, [1.0] * 6, 1), (402, [1.0, None] * 3, 1), (403, [float("nan")] * 6, 1),
             (404, [float("inf")] * 6, 1), (500, [1.0] * 5, 1), (501, [], 1)]
    assert found(spark, rows) == plain(rows)


def test_huge_components(spark):
    rows = vectors(6, 60)
    rows = [(i, [x * 1e4 for x in v], label) for i, v, label in rows]
    assert found(spark, rows) == plain(rows)
    # Vectors too long for a score take no part.
    assert found(spark, rows + [(700, [1e30] * 6, 1), (800, [3e6] * 6, 1)]) == plain(rows)


def test_empty_and_tiny_tables(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0, 2.0], 1)]) == []
