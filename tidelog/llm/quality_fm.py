"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text is a sparse vector: hashed words (counts scaled to unit length), one-hot
buckets of structure statistics, and a bucket of the stated length (metadata). The
machine adds a weight per feature and, for every pair of features, the product of
their low-rank factors; all pairs are summed in linear time as half of the square of
the sum minus the sum of the squares. The result goes through the logistic function.

The machine is fitted on a bounded sample of labelled rows: ``SAMPLE`` ids at most, the
first in an order by hash, as long as they have no more than ``MOST_FEATURES`` features in
all (one id at least). Their features, not their texts, reach the driver.
Scoring is a map over the rows with a model of fixed size.

Cases: a null or empty text has no words and is scored by its (empty) structure; a
null or missing ``n_chars`` has its own bucket; an id with several labels counts as
their mean; ids with several texts train on the smallest; null ids and labels do not
train; without any label every score is 0.5; texts of any length are read whole;
repeated rows get equal scores; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import materialize
from tidelog.storage import ship_package

# Hash buckets of words, buckets per statistic, rank of the factors.
WORD_BUCKETS, STAT_BUCKETS, RANK = 1 << 15, 16, 8
# Largest numbers of labelled documents, and of their features, that the machine is fitted on.
SAMPLE, MOST_FEATURES = 6000, 1 << 22
EPOCHS, MINIBATCH, RATE, PENALTY, SEED = 8, 64, 0.05, 1e-5, 11
# Known words per task, and characters per slice.
CACHE, SLICE_CHARS = 300_000, 1 << 20

STATISTICS = (
    "characters", "words", "different_words", "word_length", "upper_case", "digits", "symbols", "exclamations",
    "punctuation", "lines", "repeated_lines", "stated_length",
)
N_FEATURES = WORD_BUCKETS + len(STATISTICS) * STAT_BUCKETS

_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_PUNCTUATION = b".,;:?"


class _Buckets(dict):
    """Hash bucket of each word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        bucket = self[word] = zlib.crc32(word) % WORD_BUCKETS
        return bucket


def _size_bucket(n: int) -> int:
    return min(STAT_BUCKETS - 1, int(n).bit_length())


def _share_bucket(part: int, whole: int) -> int:
    """Finer for small shares: half of the buckets lie below a quarter."""
    share = part / whole if whole else 0.0
    return 0 if part == 0 else min(STAT_BUCKETS - 1, 1 + int((STAT_BUCKETS - 1) * share**0.5))


def features(text: str | None, stated: int | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the features of a text."""
    data = (text or "").encode()
    words = data.split()
    lines = [s for s in data.split(b"\n") if s.strip()]
    size = len(data)

    def share(characters: bytes) -> int:
        return _share_bucket(size - len(data.translate(None, characters)), size)

    statistics = (
        _size_bucket(size),
        _size_bucket(len(words)),
        _share_bucket(len(set(words)), len(words)),
        min(STAT_BUCKETS - 1, size // max(1, len(words))),
        share(_UPPER), share(_DIGITS), share(_SYMBOLS), share(b"!"), share(_PUNCTUATION),
        _size_bucket(len(lines)),
        _share_bucket(len(lines) - len(set(lines)), len(lines)),
        STAT_BUCKETS - 1 if stated is None else min(STAT_BUCKETS - 2, int(max(0, stated)).bit_length() // 2),
    )
    places = WORD_BUCKETS + np.arange(len(STATISTICS)) * STAT_BUCKETS + np.array(statistics)
    if not words:
        return places, np.ones(len(places), np.float32)
    hashed, counts = np.unique(np.fromiter(map(buckets.__getitem__, words), np.int64, len(words)), return_counts=True)
    values = counts / np.sqrt((counts * counts).sum())
    return np.concatenate([hashed, places]), np.concatenate([values, np.ones(len(places))]).astype(np.float32)


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def logits(self, places: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One number per row; rows are runs of features from ``starts`` on, none empty."""
        scaled = self.factors[places] * values[:, None]
        sums = np.add.reduceat(scaled, starts, axis=0)
        squares = np.add.reduceat(scaled * scaled, starts, axis=0)
        linear = np.add.reduceat(self.weights[places] * values, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Machine:
    """Logistic loss by AdaGrad, in minibatches in a seeded order."""
    random = np.random.default_rng(SEED)
    machine = Machine(0.0, np.zeros(N_FEATURES, np.float32), random.normal(0, 0.02, (N_FEATURES, RANK)).astype(np.float32))
    if not len(rows):
        machine.factors[:] = 0
        return machine
    seen_w, seen_v, seen_b = np.full(N_FEATURES, 1e-6, np.float32), np.full((N_FEATURES, RANK), 1e-6, np.float32), 1e-6
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for k in range(0, len(order), MINIBATCH):
            batch = order[k:k + MINIBATCH]
            places = np.concatenate([rows[i][0] for i in batch])
            values = np.concatenate([rows[i][1] for i in batch])
            lengths = np.array([len(rows[i][0]) for i in batch])
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
            error = (logistic(machine.logits(places, values, starts)) - labels[batch]) / len(batch)
            each = np.repeat(error, lengths)
            scaled = machine.factors[places] * values[:, None]
            sums = np.repeat(np.add.reduceat(scaled, starts, axis=0), lengths, axis=0)
            used, where = np.unique(places, return_inverse=True)
            grad_v = np.zeros((len(used), RANK))
            np.add.at(grad_v, where, (each * values)[:, None] * (sums - scaled))
            grad_v += PENALTY * machine.factors[used]
            grad_w = np.bincount(where, each * values, len(used)) + PENALTY * machine.weights[used]
            seen_v[used] += grad_v**2
            seen_w[used] += grad_w**2
            seen_b += error.sum() ** 2
            machine.factors[used] -= (RATE * grad_v / np.sqrt(seen_v[used])).astype(np.float32)
            machine.weights[used] -= (RATE * grad_w / np.sqrt(seen_w[used])).astype(np.float32)
            machine.bias -= RATE * error.sum() / np.sqrt(seen_b)
    return machine


def _with_length(docs: DataFrame) -> DataFrame:
    known = "n_chars" in docs.columns
    length = F.col("n_chars").cast("long") if known else F.lit(None).cast("long")
    return docs.select("doc_id", "text", length.alias("n_chars"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = MOST_FEATURES) -> Machine:
    """Fit on the documents of ``labels`` (``doc_id, quality``), ``sample`` ids at most. Ids may be of any type."""
    spark = docs.sparkSession
    ship_package(spark)
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.avg(F.col("quality").cast("double")).alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = (
        _with_length(docs).join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label").agg(F.min(F.struct("text", "n_chars")).alias("d"))
        .select("doc_id", "label", "d.text", "d.n_chars")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            found = [features(t.as_py(), n.as_py(), buckets) for t, n in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float32()))],
                names=["doc_id", "label", "places", "vals"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = materialize(texts.mapInArrow(work, f"doc_id {kind}, label double, places array<int>, vals array<float>"), "fm-features")
    # At most ``sample`` rows are in this order.
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = found.select("doc_id", F.size("places").alias("n")).withColumns(
        {"until": F.sum("n").over(order), "rank": F.count(F.lit(1)).over(order)}
    )
    within = sized.filter((F.col("until") <= most) | (F.col("rank") == 1)).select("doc_id")
    table = found.join(F.broadcast(within), "doc_id").toArrow().sort_by("doc_id")
    rows = [
        (p.values.to_numpy().astype(np.int64), v.values.to_numpy())
        for p, v in zip(table.column("places"), table.column("vals"))
    ]
    return train(rows, table.column("label").to_numpy())


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """``doc_id, score`` of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(machine)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        for batch in batches:
            scores, part, size = [], [], 0
            for text, stated in zip(batch.column(1), batch.column(2)):
                value = text.as_py()
                part.append(features(value, stated.as_py(), buckets))
                size += len(value or "")
                if size >= SLICE_CHARS:
                    scores.append(_score(shared.value, part))
                    part, size = [], 0
            if part:
                scores.append(_score(shared.value, part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                names=["doc_id", "score"],
            )

    rows = _with_length(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, score double")


def _score(machine: Machine, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    lengths = np.array([len(r[0]) for r in rows])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    logits = machine.logits(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), starts)
    return logistic(logits.astype(np.float64))
