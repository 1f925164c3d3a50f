import hashlib
import os
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.helpers import DOCS, plain_fingerprint, plain_roots, prose, split_words
from tests.llm.test_lines import plain as plain_lines
from tests.llm.test_mixing import plain_targets
from tidelog.llm import lines, mixing, stages
from tidelog.storage import shared_dir

DE = ("der", "und", "nicht", "stein", "fluss", "morgen", "papier", "wald", "sich", "gehen")


def corpus():
    seeded = random.Random(6)
    rows = []
    for k in range(120):
        language = ("en", "de")[k % 3 == 0]
        body = prose(seeded, 60, DE) if language == "de" else prose(seeded, 60)
        rows.append([k, f"Menu of the site\n{body}\nlast line {k}", language, f"s{k % 4}", None])
    rows += [[200 + k, rows[5][1], "en", "s1", None] for k in range(3)]
    rows += [[300, rows[7][1] + " tail", None, "s2", None], [301, "12 34 !", "en", "s0", None], [302, None, "de", None, None]]
    rows += [[303, "", None, "s0", None], [304, prose(seeded, 30_000), "en", None, None], [None, prose(seeded, 40), None, None, None]]
    return [tuple(r) for r in rows]


def brute_force(rows):
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    cleaned = plain_lines([(r[3], r[1]) for r in kept], lines.RATIO, lines.MIN_PAGES)
    docs = [(r[0], text, r[3]) for r, (_, text) in zip(kept, cleaned)]
    prints = [plain_fingerprint(t) for _, t, _ in docs]
    roots = plain_roots(set(prints), lambda a, b: (a ^ b).bit_count() <= 3)
    groups = {}
    for doc, p in zip(docs, prints):
        groups.setdefault(roots[p], []).append(doc)
    docs = [min(g, key=lambda d: (d[0] is None, d[0] or 0)) for g in groups.values()]
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len(split_words(text))
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    targets = plain_targets(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5, 2.0)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for source in sizes:
        bins = {}
        own = [d for d in docs if d[2] == source]
        digit = {d[0]: int(hashlib.md5(f"{mixing.SEED}:{'' if d[0] is None else d[0]}".encode()).hexdigest()[:3], 16) for d in own}
        for d in own:
            bins[digit[d[0]]] = bins.get(digit[d[0]], 0) + len(split_words(d[1]))
        whole = int(targets[source] // sizes[source])
        extra, before, last = targets[source] - whole * sizes[source], 0, -1
        for b in sorted(bins):
            if before + bins[b] / 2 <= extra:
                last = b
            before += bins[b]
        for doc_id, text, _ in own:
            ids = library.encode(text, add_special_tokens=False).ids
            out += [(doc_id, tuple(ids))] * (whole + (digit[doc_id] <= last))
    return out


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    folder = shared_dir(spark).removeprefix("file://")
    there = set(os.listdir(folder))
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # The result alone is left.
    assert [n.partition("-")[2].partition("-")[0] for n in set(os.listdir(folder)) - there] == ["encoding"]
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in result)
    assert sorted(((r["doc_id"], tuple(r["ids"])) for r in result), key=str) == sorted(brute_force(rows), key=str)


def test_stages_keep_columns_and_take_empty_tables(spark):
    docs = spark.createDataFrame(corpus()[:20], DOCS).withColumnRenamed("n_chars", "_lang").selectExpr("*", "1 AS _score", "2 AS _fp")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns, name
        assert stage(spark, docs.filter("false"), "").count() == 0, name
    assert stages.encode_stage(spark, docs.filter("false"), "").count() == 0


def test_noise_and_unlearned_languages_go(spark):
    seeded = random.Random(8)
    rows = corpus()
    rows += [(400, " ".join("".join(seeded.choice("qxzjvkwy") for _ in range(8)) for _ in range(200)), None, "s0", None),
             (401, "кто не работает тот не ест и живёт у моря " * 20, None, "s0", None), (402, prose(seeded, 5), None, "s1", None)]
    kept = {r["doc_id"] for r in stages.language_stage(spark, spark.createDataFrame(rows, DOCS), "").collect()}
    assert not kept & {301, 302, 303, 400, 401}
    assert kept == {r[0] for r in rows} - {301, 302, 303, 400, 401}



def test_order_of_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "copies", "mixing", "encoding"]
