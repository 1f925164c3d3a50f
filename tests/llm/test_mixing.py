import pytest

from tests.llm.helpers import DOCS, split_words
from tidelog.llm import mixing


def plain_targets(sizes, weights, share, epochs):
    """Fill by weight, clamp what is above its limit, share again."""
    total, full = share * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in full}
        left = total - sum(full.values())
        targets = {s: left * w / sum(free.values()) for s, w in free.items()}
        over = [s for s in targets if targets[s] > epochs * sizes[s]]
        if not over:
            return {**full, **targets}
        full.update({s: epochs * sizes[s] for s in over})


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for source, n, words in (("a", 300, 7), ("b", 40, 30), ("ä", 900, 5), ("B", 500, 11), (None, 60, 9), ("e", 5, 0)):
        rows += [(len(rows) + k, "w " * (words + k % 3 if words else 0), None, source, None) for k in range(n)]
    rows += [(None, None, None, "a", None), (3, "again here", None, "a", None), (3, "again here", None, "a", None)]
    return spark.createDataFrame(rows, DOCS)


def test_targets_and_taken(docs):
    got = mixing.mix(docs).collect()
    sizes, taken, targets = {}, {}, {}
    for r in got:
        s = r["source"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["size"] * r["copies"]
        targets[s] = r["target"]
        assert r["copies"] <= 2
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    expected = plain_targets(sizes, dict(zip(names, [3, 1, 2, 3, 1, 2])), 1.5, 2.0)
    assert targets == pytest.approx(expected)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 0.03 * max(targets[s], 1)
    assert {r["source"]: r["source_size"] for r in got} == sizes
    assert all(r["size"] == len(split_words(t)) for r, t in zip(
        sorted((r for r in got if r["doc_id"] is not None), key=lambda r: (r["doc_id"], r["size"])),
        [d["text"] for d in sorted((d for d in docs.collect() if d["doc_id"] is not None), key=lambda d: (d["doc_id"], len(split_words(d["text"]))))]))


def test_reruns_agree_and_documents_follow(docs):
    first, second = (sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (1, 7))
    assert first == second
    copies = {(r["doc_id"], r["source"]): r["copies"] for r in mixing.mix(docs).collect()}
    mixed = mixing.mix_documents(docs.withColumnRenamed("lang", "_whole"))
    assert mixed.columns == ["doc_id", "text", "_whole", "source", "n_chars"]
    found = {}
    for r in mixed.collect():
        found[(r["doc_id"], r["source"])] = found.get((r["doc_id"], r["source"]), 0) + 1
    twice = (3, "a")
    assert {k: v for k, v in found.items() if k != twice} == {k: v for k, v in copies.items() if v and k != twice}


def test_empty_documents_of_a_source_at_its_limit(spark):
    rows = [(k, "w " * 3, None, "small", None) for k in range(20)] + [(100 + k, " ", None, "small", None) for k in range(200)]
    rows += [(1000 + k, "w " * 50, None, "large", None) for k in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs, weights=(1, 3)).filter("source = 'small'").collect()
    assert {r["target"] for r in got} == {2.0 * 60} and {r["copies"] for r in got} == {2}
    assert mixing.mix_documents(docs, weights=(1, 3)).filter("source = 'small'").count() == 440


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixing.mix_documents(spark.createDataFrame([], DOCS)).count() == 0
    blank = spark.createDataFrame([(1, None, None, None, None), (2, " ", None, "x", None)], DOCS)
    assert {(r["size"], r["target"], r["copies"]) for r in mixing.mix(blank).collect()} == {(0, 0.0, 1)}
