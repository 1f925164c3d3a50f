"""Every query of the subpackage over the smallest tables, against its SQL where it has one."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from tidelog.llm.queries import QUERIES
from tidelog.llm.sql import ORACLE
from tidelog.plans.compare import oracle_connection, same_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are missing")


def test_all_are_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    assert same_rows(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLE[name]) is None


# Checked piece by piece in a test of its own.
PIECES = {"op11_packing"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - PIECES))
def test_query_gives_a_row_for_each_input(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    table = {"op6_url_filter": "pages", "op10_nearest": "embeddings"}.get(name, "documents")
    n = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    assert rows.count() == (n // 20 * 20 if name == "op10_nearest" else n)


def test_the_bench_times_the_pipeline(monkeypatch):
    import bench

    monkeypatch.delenv("BENCH_QUERIES", raising=False)
    assert "pipeline" in bench.names_of(bench.queries())


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()


def test_bpe_query_equals_the_library(spark):
    import hashlib

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for r in documents(spark):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, QUERIES["op2_bpe"](spark, SF_DIR).collect())) == sorted(expected)


def test_simhash_query_equals_brute_force(spark):
    from tests.llm.helpers import plain_fingerprint, plain_roots

    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in documents(spark)}
    roots = plain_roots(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    expected = sorted((d, f"{p:016x}", roots[d]) for d, p in prints.items())
    assert sorted(map(tuple, QUERIES["op9_simhash"](spark, SF_DIR).collect())) == expected


def test_nearest_query_finds_most_and_scores_exactly(spark):
    import numpy as np

    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in rows}
    found = {}
    for r in QUERIES["op10_nearest"](spark, SF_DIR).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in vectors if i % 20 == 0}
    hits = total = 0
    for query, answers in found.items():
        scores = {i: float(vectors[query] @ v) for i, v in vectors.items() if i != query}
        true = sorted(scores, key=lambda i: (-scores[i], i))[:20]
        assert [a[0] for a in answers] == list(range(1, 21))
        assert all(abs(scores[i] - s) < 1e-12 for _, i, s in answers)
        assert [a[1] for a in answers] == sorted([a[1] for a in answers], key=lambda i: (-dict((x[1], x[2]) for x in answers)[i], i))
        hits, total = hits + len(set(true) & {a[1] for a in answers}), total + 20
    assert hits >= 0.9 * total
