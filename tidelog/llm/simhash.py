"""SimHash near-duplicates: fingerprints within a few bits, found by pigeonring filtering.

A fingerprint has four segments of 16 bits in a ring. If two fingerprints differ
in at most 3 bits, then from some segment on the differences of 1, 2, 3 and 4
consecutive segments are at most 0, 1, 2 and 3 (their proportional shares of 3,
rounded down). So a pair agrees in that segment and, having at most one difference
in the next, in one half of the next: these 24 bits, for every start and half, are
the keys under which fingerprints meet. Pairs that meet must pass the chain of
budgets before their full distance is counted.

Exact copies share one fingerprint and are joined again at the end. A key with more
than ``BLOCK`` fingerprints is dealt as pairs of blocks to many tasks; a task keeps
only a spanning forest of the links that it finds, so that no group gives all its pairs.

Cases: a null or empty text has fingerprint 0, linked like any other; one or two
words are one shingle; null ids take part and never name a component unless it
has no other id (then it is null); rows with the same id are rows of their own; an
empty table gives no rows; extra columns are kept by ``drop_near_copies`` and
ignored elsewhere. Texts of any length are hashed whole, in chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import free_name, materialize, small_side
from tidelog.llm.components import components
from tidelog.storage import ship_package

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SEGMENTS, SEGMENT_BITS, HALF_BITS = 4, 16, 8
# Largest number of fingerprints of one key that are compared as one block.
BLOCK = 2048
CHUNK = 1 << 15

# Differences allowed in 1, 2, 3 and 4 consecutive segments.
BUDGETS = [(n + 1) * MAX_BITS // SEGMENTS for n in range(SEGMENTS)]


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit fingerprint: bits set in over half the hashes of the 3-word shingles."""
    # bytes.lower and bytes.split touch ASCII letters and blanks only.
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(SHINGLE, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = ends - lengths + 1
    starts, ends = starts[: len(words) - width + 1], ends[width - 1:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(starts), CHUNK):
        places = zip(starts[k:k + CHUNK].tolist(), ends[k:k + CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in places], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    bits = (counts * 2 > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """Add the fingerprint of the column ``text`` as a (signed) long."""
    ship_package(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    text = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py()) for t in batch.column(text)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=schema.names)

    return docs.mapInArrow(add, schema)


def _union(parent: np.ndarray, a: int, b: int) -> bool:
    while parent[a] != a:
        a = parent[a]
    while parent[b] != b:
        b = parent[b]
    if a == b:
        return False
    parent[max(a, b)] = min(a, b)
    return True


def forest(keys: np.ndarray, groups: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs that span the links inside each run of equal groups."""
    n = len(prints)
    change = np.flatnonzero(groups[1:] != groups[:-1]) + 1
    ends = np.repeat(np.append(change, n), np.diff(np.concatenate(([0], change, [n]))))
    parent = np.arange(n)
    shift = (keys >> 25).astype(np.uint64) * np.uint64(SEGMENT_BITS)
    masks = [np.uint64((1 << SEGMENT_BITS * (k + 1)) - 1) for k in range(SEGMENTS)]
    left, right = [], []
    active, distance = np.arange(n), 1
    while True:
        active = active[active + distance < ends[active]]
        if not len(active):
            break
        a = active
        x = prints[a] ^ prints[a + distance]
        s = shift[a]
        # Rotate, so that the start of the chain is the lowest segment.
        x = (x >> s) | (x << ((np.uint64(64) - s) & np.uint64(63)))
        for mask, budget in zip(masks, BUDGETS):
            keep = np.bitwise_count(x & mask) <= budget
            a, x = a[keep], x[keep]
        keep = parent[a] != parent[a + distance]
        found = False
        for p in a[keep].tolist():
            if _union(parent, p, p + distance):
                left.append(p)
                right.append(p + distance)
                found = True
        while found:
            above = parent[parent]
            found = not np.array_equal(above, parent)
            parent = above
        distance += 1
    return np.array(left, np.int64), np.array(right, np.int64)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows ``key, lo, hi, fp``; a group that a batch cuts is carried on."""
    names = ["u", "v"]
    rest = None
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)])
        if rest is not None:
            rows = np.concatenate([rest, rows], axis=1)
        same = (rows[:3] == rows[:3, -1:]).all(axis=0)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        rest = rows[:, cut:]
        yield _links(rows[:, :cut], names)
    if rest is not None:
        yield _links(rest, names)


def _links(rows: np.ndarray, names: list[str]) -> pa.RecordBatch:
    key, lo, hi, prints = rows
    if not len(key):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, names=names)
    change = (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)
    groups = np.concatenate(([0], np.cumsum(change)))
    left, right = forest(key, groups, prints.view(np.uint64))
    return pa.RecordBatch.from_arrays([pa.array(prints[left]), pa.array(prints[right])], names=names)


def link_fingerprints(prints: DataFrame, block: int = BLOCK) -> DataFrame:
    """``u, v``: links that join all different fingerprints (``fp``) within reach of each other."""
    ship_package(prints.sparkSession)

    def key(start: int, half: int):
        def part(segment: int):
            return F.shiftrightunsigned("fp", SEGMENT_BITS * (segment % SEGMENTS)).bitwiseAND((1 << SEGMENT_BITS) - 1)

        next_half = F.shiftright(part(start + 1), HALF_BITS * half).bitwiseAND((1 << HALF_BITS) - 1)
        number = (2 * start + half) << (SEGMENT_BITS + HALF_BITS)
        return F.lit(number).cast("long") + F.shiftleft(part(start), HALF_BITS) + next_half

    keys = prints.select(
        F.explode(F.array(*[key(s, h) for s in range(SEGMENTS) for h in range(2)])).alias("key"), "fp"
    )
    large = materialize(
        keys.groupBy("key").count().filter(F.col("count") > block)
        .select("key", F.ceil(F.col("count") / block).cast("long").alias("blocks")),
        "large-keys",
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    dealt = (
        keys.join(small_side(large), "key", "left")
        .fillna(1, ["blocks"])
        .select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    )
    return (
        dealt.repartition("key", "lo", "hi")
        .sortWithinPartitions("key", "lo", "hi", "fp")
        .mapInArrow(_scan, "u long, v long")
    )


def fingerprint_roots(prints: DataFrame) -> DataFrame:
    """``fp, root`` for different fingerprints: the smallest one that links lead to."""
    linked = components(link_fingerprints(prints)).withColumnRenamed("node", "fp")
    return prints.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, component_id`` for every row."""
    hashed = materialize(with_fingerprint(docs.select("doc_id", "text"), "fp").drop("text"), "fingerprints")
    smallest = materialize(hashed.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "different-fingerprints")
    rooted = materialize(fingerprint_roots(smallest.select("fp")).join(smallest, "fp"), "fingerprint-roots")
    least = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return hashed.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One row of each group, the one with the smallest id; all columns are kept.

    Rows get numbers when they are written with their fingerprints, so that rows
    with equal or null ids can be told apart.
    """
    fp, row = free_name(docs, "_fp"), free_name(docs, "_row")
    hashed = materialize(
        with_fingerprint(docs, fp).withColumn(row, F.monotonically_increasing_id()), "fingerprinted"
    )
    ids = hashed.select(F.col(fp).alias("fp"), F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.col(row).alias("row")).alias("who"))
    smallest = materialize(ids.groupBy("fp").agg(F.min("who").alias("who")), "different-fingerprints")
    roots = fingerprint_roots(smallest.select("fp"))
    kept = smallest.join(roots, "fp").groupBy("root").agg(F.min("who").alias("who")).select(F.col("who.row").alias(row))
    return hashed.join(kept, row, "left_semi").select(*docs.columns)
