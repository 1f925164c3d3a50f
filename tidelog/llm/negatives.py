"""Hard negatives by exact scores from a residue number system.

Vectors become integers, and integer inner products are wanted exactly. The matrices
are taken modulo several small primes, each product of residues is a float32 matrix
product whose sums stay below ``2 ** 24`` and so are exact, and the signed score is put
together again by the Chinese remainder theorem (in mixed radix). As many primes are
taken as the largest possible score needs, which follows from the longest vector.

Anchors meet rows in blocks of bounded size. The first pass compares an anchor with rows
of its own label and keeps the best as its positives; the second compares it with all
rows and keeps, for each positive, the best of the other labels whose scores lie in the
window that the positive's score sets. A block keeps a few rows for each anchor, and
windows over these give the result.

Cases: rows with a null id, label or vector, with a null or non-finite component, or with
another length than most (the largest of several) take no part, nor do vectors whose
squared integer length is ``2 ** 59`` or more, as scores would not fit a long; rows
equal in id, label and integer vector count once; a row is no positive of a row with its
own id; ties go to the smaller id; fewer candidates are all returned; a zero vector is a
vector; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialize
from tidelog.storage import ship_package

# float32 holds all integers up to here; primes are the largest below LARGEST.
EXACT, LARGEST = 1 << 24, 1024
LONGEST_SQUARE = 2.0**59
# Rows and anchors of a block, rows that are too few to be split, anchors at a time.
ROW_BLOCK, ANCHOR_BLOCK, LEAST_BLOCK, STEP = 8192, 2048, 512, 128
# Labels share this many groups in the first pass.
LABEL_GROUPS = 64


# --- the residue number system ------------------------------------------------------


def primes_for(bound: int) -> list[int]:
    """Largest primes below ``LARGEST`` whose product exceeds all differences of scores up to ``bound``."""
    found, product = [], 1
    for n in range(LARGEST - 1, 2, -1):
        if product > 2 * bound + 1:
            break
        if all(n % k for k in range(2, math.isqrt(n) + 1)):
            found.append(n)
            product *= n
    return found


def residues(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Components modulo a prime, around zero."""
    r = matrix % prime
    return (r - prime * (r > prime // 2)).astype(np.float32)


class Scores:
    """Exact inner products of integer rows with a fixed block of integer rows."""

    def __init__(self, block: np.ndarray, primes: list[int]):
        self.primes = primes
        self.block = [residues(block, p) for p in primes]

    def of(self, rows: np.ndarray) -> np.ndarray:
        digits, primes = [], self.primes
        for block, p in zip(self.block, primes):
            left = residues(rows, p)
            # So many products of residues add up exactly.
            width = max(1, (EXACT - 1) // (p // 2) ** 2)
            total = np.zeros((len(rows), len(block)), np.int64)
            for start in range(0, rows.shape[1], width):
                part = left[:, start:start + width] @ block[:, start:start + width].T
                total += part.astype(np.int64)
            digits.append(total % p)
        # Mixed radix: each digit is what is left of the residue after the lower ones.
        score = np.zeros_like(digits[0])
        weight = 1
        for residue, p in zip(digits, primes):
            digit = (residue - score % p) * pow(weight, -1, p) % p
            digit -= p * (digit > p // 2)
            score = score + weight * digit
            weight *= p
        return score


# --- selection ------------------------------------------------------------------------


@dataclass(frozen=True)
class Mining:
    """How many positives and negatives, and the window: a negative's score is between
    ``low`` and ``high`` tenths of the positive's."""

    positives: int = 5
    negatives: int = 10
    low: int = 3
    high: int = 9


def _first(scores: np.ndarray, candidates: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` best of ``candidates`` (rising positions) by score; ties keep their order."""
    if len(candidates) > n:
        found = scores[candidates]
        candidates = candidates[found >= np.partition(found, -n)[-n]]
    return candidates[np.argsort(-scores[candidates], kind="stable")][:n]


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors of a block, by id."""
    ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
    vectors = np.stack(table.column("c").to_numpy()).astype(np.int64)
    order = np.lexsort((labels, ids))
    return ids[order], labels[order], vectors[order]


def _result(columns: list[list], names: list[str]) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


POSITIVE = ["anchor_id", "anchor_key", "positive_id", "positive_score"]
NEGATIVE = ["anchor_id", "anchor_key", "positive_id", "positive_nth", "negative_id", "positive_score", "negative_score"]


def positives_of(anchors: pa.Table, rows: pa.Table, primes: list[int], n: int) -> pa.Table:
    """The ``n`` best rows of a block with the label of each anchor."""
    out: list[list] = [[] for _ in POSITIVE]
    if anchors.num_rows and rows.num_rows:
        ids, labels, vectors = _rows(rows)
        scores = Scores(vectors, primes)
        for start in range(0, anchors.num_rows, STEP):
            part = anchors.slice(start, STEP)
            found = scores.of(np.stack(part.column("c").to_numpy()).astype(np.int64))
            asked = zip(*(part.column(c).to_pylist() for c in ("anchor_id", "anchor_key", "label")))
            for (anchor, key, label), row in zip(asked, found):
                best = _first(row, np.flatnonzero((labels == label) & (ids != anchor)), n)
                for values, column in zip((np.full(len(best), anchor), np.full(len(best), key), ids[best], row[best]), out):
                    column.extend(values.tolist())
    return _result(out, POSITIVE)


def negatives_of(anchors: pa.Table, rows: pa.Table, primes: list[int], mining: Mining) -> pa.Table:
    """The best rows of a block with other labels, for each positive of each anchor."""
    out: list[list] = [[] for _ in NEGATIVE]
    if anchors.num_rows and rows.num_rows:
        ids, labels, vectors = _rows(rows)
        scores = Scores(vectors, primes)
        for start in range(0, anchors.num_rows, STEP):
            part = anchors.slice(start, STEP)
            found = scores.of(np.stack(part.column("c").to_numpy()).astype(np.int64))
            asked = zip(*(part.column(c).to_pylist() for c in ("anchor_id", "anchor_key", "label", "positives")))
            for (anchor, key, label, positives), row in zip(asked, found):
                others = np.flatnonzero(labels != label)
                for positive in positives:
                    nth, score = positive["nth"], positive["score"]
                    values = row[others]
                    inside = others[(values >= -(-mining.low * score // 10)) & (values <= mining.high * score // 10)]
                    best = _first(row, inside, mining.negatives)
                    n = len(best)
                    columns = ([anchor] * n, [key] * n, [positive["id"]] * n, [nth] * n, ids[best].tolist(), [score] * n, row[best].tolist())
                    for values, column in zip(columns, out):
                        column.extend(values)
    return _result(out, NEGATIVE)


# --- jobs -------------------------------------------------------------------------------


def integer_rows(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """``vec_id, label, c`` (``floor(scale * x)`` of each component), ``square``: usable rows, each once."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    whole = F.transform(x, lambda v: F.floor(v * scale))
    usable = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    square = F.aggregate(x, F.lit(0.0), lambda total, v: total + F.floor(v * scale).cast("double") * F.floor(v * scale).cast("double"))
    rows = vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL").filter(usable & label.isNotNull())
    # A component of 2 ** 30 or more has no integer here, and its square is too long anyway.
    rows = rows.withColumn("_largest", F.coalesce(F.array_max(F.transform(x, lambda v: F.abs(v * scale))), F.lit(0.0)))
    rows = rows.filter((F.col("_largest") < 2.0**30) & (square < LONGEST_SQUARE))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.try_cast("array<int>").alias("c"),
        square.alias("square"),
    ).distinct()


def mine(vectors: DataFrame, label: Column, asked: Column, scale: int = 256, mining: Mining = Mining()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows of
    ``vectors`` (``vec_id, embedding`` and what ``label`` needs) for which ``asked`` holds."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialize(integer_rows(vectors, label, scale), "negatives-rows")
    lengths = rows.groupBy(F.size("c").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("square"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d, n, longest = (common["d"], common["n"], common["square"]) if common else (0, 0, 0.0)
    # No score is larger than the longest squared length; doubles round, so a little more.
    primes = primes_for(int(longest * 1.001) + 1)
    rows = rows.filter(F.size("c") == d).drop("square")
    anchors = materialize(rows.filter(asked).select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("vec_id", "label", "c").alias("anchor_key"), "label", "c"
    ), "negatives-anchors")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(count: int) -> int:
        """Enough for the bound, and for all tasks if the blocks do not get too small."""
        return max(1, math.ceil(count / ROW_BLOCK), min(tasks, count // LEAST_BLOCK))

    def block(key: str, count: Column) -> Column:
        return F.pmod(F.xxhash64(key, F.lit("block")), count).cast("int")

    # First pass: within groups of labels, whose sizes are known.
    group = F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int").alias("g")
    sizes = {r["g"]: (r["n"], r["a"]) for r in rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(asked, 1).otherwise(0)).alias("a")).collect()}
    row_blocks = F.array(*[F.lit(blocks(sizes.get(g, (0, 0))[0])) for g in range(LABEL_GROUPS)])
    anchor_blocks = F.array(*[F.lit(max(1, math.ceil(sizes.get(g, (0, 0))[1] / ANCHOR_BLOCK))) for g in range(LABEL_GROUPS)])

    def spread(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    same = ["g", "rb", "ab"]
    grouped_anchors = anchors.withColumn("g", group).withColumns(
        {"ab": block("anchor_id", F.get(anchor_blocks, F.col("g"))), "rb": spread(F.get(row_blocks, F.col("g")))}
    )
    grouped_rows = rows.withColumn("g", group).withColumns(
        {"rb": block("vec_id", F.get(row_blocks, F.col("g"))), "ab": spread(F.get(anchor_blocks, F.col("g")))}
    )
    near = grouped_anchors.groupBy(*same).cogroup(grouped_rows.groupBy(*same)).applyInArrow(
        lambda a, r: positives_of(a, r, primes, mining.positives), ", ".join(f"{c} long" for c in POSITIVE)
    )
    order = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("positive_score"), "positive_id")
    windows = (
        near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= mining.positives)
        .groupBy("anchor_id", "anchor_key")
        .agg(F.collect_list(F.struct("nth", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives"))
    )

    # Second pass: all rows.
    n_blocks, n_anchors = blocks(n), sum(a for _, a in sizes.values())
    with_windows = materialize(anchors.join(windows, ["anchor_id", "anchor_key"]), "negatives-windows")
    all_anchors = with_windows.withColumns(
        {"ab": block("anchor_id", F.lit(max(1, math.ceil(n_anchors / ANCHOR_BLOCK)))), "rb": spread(F.lit(n_blocks))}
    )
    all_rows = rows.withColumns(
        {"rb": block("vec_id", F.lit(n_blocks)), "ab": spread(F.lit(max(1, math.ceil(n_anchors / ANCHOR_BLOCK))))}
    )
    both = ["rb", "ab"]
    found = all_anchors.groupBy(*both).cogroup(all_rows.groupBy(*both)).applyInArrow(
        lambda a, r: negatives_of(a, r, primes, mining), ", ".join(f"{c} long" for c in NEGATIVE)
    )
    order = Window.partitionBy("anchor_id", "anchor_key", "positive_nth").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= mining.negatives)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
