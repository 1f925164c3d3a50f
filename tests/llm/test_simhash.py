import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import DOCS, plain_fingerprint, plain_roots, prose
from tidelog.llm import simhash
from tidelog.llm.components import components


def near(a, b):
    return ((a ^ b) & (2**64 - 1)).bit_count() <= simhash.MAX_BITS


def cloud(seed, n):
    """Fingerprints around a few centres, in chains and alone."""
    seeded = random.Random(seed)
    found = set()
    for _ in range(n // 20):
        value = seeded.getrandbits(64)
        for _ in range(20):
            found.add(value)
            for _ in range(seeded.randint(0, 4)):
                value ^= 1 << seeded.randrange(64)
    return sorted(found)


def test_fingerprint_equals_the_definition():
    seeded = random.Random(2)
    texts = [prose(seeded, n) for n in (1, 2, 3, 4, 50, 400)]
    texts += ["", None, " \t\n", "ÀB Ab aB", "É é x", "a\x0bb\x0cc\x1cd\x85e f"]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_chunks_change_nothing(monkeypatch):
    text = prose(random.Random(1), 500)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def test_budgets_lose_no_pair():
    """Every pattern of three or fewer bits passes the chain from some start."""
    seeded = random.Random(4)
    for _ in range(3000):
        x = 0
        for _ in range(seeded.randint(0, 3)):
            x |= 1 << seeded.randrange(64)
        starts = [((x >> 16 * s) | (x << 64 - 16 * s)) & (2**64 - 1) for s in range(4)]
        assert any(
            all((y & ((1 << 16 * (k + 1)) - 1)).bit_count() <= b for k, b in enumerate(simhash.BUDGETS)) for y in starts
        )


def roots(spark, prints, block):
    df = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    linked = components(simhash.link_fingerprints(df, block))
    found = df.join(linked, df.fp == linked.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return {r["fp"]: r["root"] for r in found.collect()}


def test_components_equal_brute_force_with_and_without_blocks(spark):
    prints = cloud(7, 400)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    expected = plain_roots(signed, near)
    assert roots(spark, prints, simhash.BLOCK) == expected
    assert roots(spark, prints, 4) == expected


def test_dense_group_gives_a_forest(spark):
    prints = [1 << a | 1 << b for a in range(16) for b in range(a)]
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    per_key = simhash.link_fingerprints(df).count() / 8
    assert per_key < len(prints)


def test_groups_of_documents(spark):
    seeded = random.Random(3)
    base = prose(seeded, 300)
    texts = [base, base + " end", base.upper(), prose(seeded, 300), None, "", "one two", "ONE  TWO", base]
    ids = [5, 4, 9, 7, 11, 12, 1, 2, None]
    rows = [(i, t, None, None, None) for i, t in zip(ids, texts)]
    got = simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()
    prints = [plain_fingerprint(t) for t in texts]
    groups = plain_roots(set(prints), near)
    for row in got:
        assert row["component_id"] == min(
            i for i, p in zip(ids, prints) if i is not None and groups[p] == groups[row["fp"] & (2**64 - 1)]
        )
    assert len(got) == len(texts)


def test_one_row_of_each_group_stays(spark):
    base = prose(random.Random(8), 200)
    rows = [(3, base, "x", 1), (3, base, "x", 1), (None, base, "y", 2), (None, "alone here", "z", 3), (8, None, None, None), (6, "", "e", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp string, _row int")
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "alone here"), (3, base), (6, "")]
    assert simhash.drop_near_copies(docs.filter("false")).count() == 0


def test_components_of_a_long_chain_and_nothing(spark):
    chain = spark.range(40).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert components(chain).select("root").distinct().collect()[0]["root"] == 0
    assert components(chain).count() == 41
    assert components(chain.filter("false")).count() == 0
