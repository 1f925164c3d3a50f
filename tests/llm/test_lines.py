import pytest

from tests.llm.helpers import split_words
from tidelog.llm import lines


def plain(rows, ratio, least):
    total, pages = {}, {}
    for host, text in rows:
        total[host] = total.get(host, 0) + 1
        for line in {s for s in (text or "").split("\n") if split_words(s)}:
            pages[host, line] = pages.get((host, line), 0) + 1
    bad = {k for k, n in pages.items() if n >= least and n > ratio * total[k[0]]}
    out = []
    for host, text in rows:
        kept = [s for s in (text or "").split("\n") if (host, s) not in bad]
        some = any(split_words(s) for s in kept)
        out.append((host, "\n".join(kept) if text is not None and some else text))
    return out


def test_equals_the_definition(spark):
    rows = [("h", f"menu\nbody {k}\n\nfoot{' ' if k % 2 else ''}\nmenu") for k in range(30)]
    rows += [("g", f"menu\nother {k % 4}") for k in range(12)] + [(None, f"menu\nx {k}") for k in range(11)]
    rows += [("h", None), ("h", ""), ("h", "menu"), ("h", " \n"), ("i", "menu\nfew"), ("h", "long " * 40_000 + "\nmenu")]
    df = spark.createDataFrame(rows, "host string, text string").selectExpr("host", "text", "1 AS _kept", "2 AS _bad")
    got = lines.drop_boilerplate(df, "host", lines_name="n", dropped_name="gone")
    assert got.columns == ["host", "text", "_kept", "_bad", "n", "gone"]
    assert sorted((tuple(r)[:2] for r in got.collect()), key=str) == sorted(plain(rows, lines.RATIO, lines.MIN_PAGES), key=str)
    for r in got.filter("host = 'h' and text like 'body%'").collect():
        assert (r["n"], r["gone"]) == (4, 2 if r["text"].endswith("foot ") or r["text"].endswith("foot") else 3)


def test_large_sets_are_joined_alike(spark, monkeypatch):
    rows = [("h", f"menu\nbody {k}") for k in range(30)] + [(None, f"top\nx {k}") for k in range(20)]
    df = spark.createDataFrame(rows, "host string, text string")
    small = sorted(map(str, lines.drop_boilerplate(df, "host").collect()))
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    assert sorted(map(str, lines.drop_boilerplate(df, "host").collect())) == small


@pytest.mark.parametrize("n", [5, 50, 5000])
def test_planted_lines_at_every_host_size(spark, n):
    shares = {2: "two", 5: "five", 20: "twenty", 60: "sixty"}
    df = spark.createDataFrame(
        [("h", "\n".join([f"body {k}", *[f"line {name}" for share, name in shares.items() if 100 * k < share * n]])) for k in range(n)],
        "host string, text string",
    )
    found = {name: lines.boilerplate(df, "host").filter(f"line_hash = unhex(md5('line {name}'))").count() for name in shares.values()}
    pages = {name: -(-share * n // 100) for share, name in shares.items()}
    # Over 2 % of the pages, and three pages at least: the same rule for every host.
    assert found == {name: int(k > 0.02 * n and k >= 3) for name, k in pages.items()}
    assert found["sixty"] == 1 and found["five"] == int(n >= 50) and found["twenty"] == int(n >= 50)
    kept = lines.drop_boilerplate(df, "host").filter("text LIKE '%line sixty%'").count()
    assert kept == 0 and lines.drop_boilerplate(df, "host").filter("text LIKE 'body%'").count() == n


def test_empty(spark):
    assert lines.drop_boilerplate(spark.createDataFrame([], "host string, text string"), "host").count() == 0


def test_pages_of_boilerplate_alone_are_reported(spark):
    rows = [("h", f"menu\nbody {k}\nfoot") for k in range(30)] + [("h", "menu\n\nfoot\nmenu"), ("h", None), ("h", " "), ("g", "menu")]
    df = spark.createDataFrame(rows, "host string, text string")
    got = lines.drop_boilerplate(df, "host", dropped_name="gone", found_name="found")
    assert got.columns == ["host", "text", "gone", "found"]
    left = sorted((tuple(r) for r in got.filter("gone = 0").collect()), key=str)
    assert left == sorted([("h", "menu\n\nfoot\nmenu", 0, 3), ("h", None, 0, 0), ("h", " ", 0, 0), ("g", "menu", 0, 0)], key=str)
    assert got.filter("gone = 2 and found = 2").count() == 30
