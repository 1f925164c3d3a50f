import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute_force(rows, asked, k):
    result = {}
    for q, v in rows:
        if asked(q):
            scored = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)
            result[q] = [(i, -s) for s, i in scored[:k]]
    return result


def run(spark, rows, asked, k, share=ann.SHARE):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    found = {}
    for r in ann.search(df, asked, k, share).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


def vectors(n, d, seed):
    values = np.random.default_rng(seed).normal(size=(n, d)).astype(np.float32)
    return [(i, values[i].tolist()) for i in range(n)]


def test_recall_and_scores(spark):
    rows = vectors(1500, 32, 1)
    got, truth = run(spark, rows, F.col("vec_id") % 20 == 0, 20), brute_force(rows, lambda q: q % 20 == 0, 20)
    assert got.keys() == truth.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in truth[q]}) for q in truth)
    assert hits >= 0.9 * sum(map(len, truth.values()))
    at = dict(rows)
    for q, found in got.items():
        assert len(found) == 20
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
        for i, s in found:
            assert s == pytest.approx(float(np.dot(np.float64(at[q]), np.float64(at[i]))), abs=1e-12)


def test_whole_walk_is_exact_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "ENTRY_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 5)
    monkeypatch.setattr(ann, "STEP", 3)
    rows = vectors(300, 7, 2)
    got, truth = run(spark, rows, F.col("vec_id") % 10 == 0, 5, share=1.0), brute_force(rows, lambda q: q % 10 == 0, 5)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in truth.items()}


def test_many_copies_and_ties(spark):
    rows = vectors(40, 4, 3) + [(100 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(200)]
    got, truth = run(spark, rows, F.col("vec_id") == 120, 20, share=1.0), brute_force(rows, lambda q: q == 120, 20)
    assert [i for i, _ in got[120]] == [i for i, _ in truth[120]]


def test_bad_vectors_few_candidates_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (20, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [None, 1.0]), (6, [1.0]), (7, []), (None, [5.0, 5.0]), (40, [-1.0, 0.0])]
    got = run(spark, rows, F.col("vec_id") % 20 == 0, 20)
    assert got == {0: [(1, 4.0), (40, -1.0)], 40: [(0, -1.0), (1, -2.0)]}
    assert run(spark, rows[3:8], F.col("vec_id") % 20 == 0, 20) == {}
    assert ann.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("n", [18, 22, 40])
def test_small_tables_give_as_many_as_there_are(spark, n):
    rows = vectors(n, 6, n)
    got, truth = run(spark, rows, F.col("vec_id") == 0, 20), brute_force(rows, lambda q: q == 0, 20)
    assert [i for i, _ in got[0]] == [i for i, _ in truth[0]]


def test_walk_is_in_order():
    seeded = np.random.default_rng(4)
    first, second, sizes = seeded.normal(size=6), seeded.normal(size=5), seeded.integers(0, 3, 30)
    cells = ann.walk(first, second, sizes, int(sizes.sum()))
    sums = [first[c // 5] + second[c % 5] for c in cells]
    assert sums == sorted(sums, reverse=True)
    assert sorted(cells) == [c for c in range(30) if sizes[c]]
    short = ann.walk(first, second, sizes, 7)
    assert short == cells[: len(short)] and sizes[short].sum() >= 7 > sizes[short[:-1]].sum()
