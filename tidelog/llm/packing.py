"""Packing documents into sequences of bounded length by cutting-stock column generation.

A document is its token ids and an end id. What fills whole sequences is cut off in
pieces of the full length; the rest is one piece below it. The histogram of these
lengths, at most ``size - 1`` numbers, is the cutting-stock problem: a pattern says how
many pieces of each length share a sequence. What a pattern leaves open is padded (a
power of two needs no padding), or filled from documents that are set aside to be cut,
at the price of ``CUT``. A linear program over patterns and documents set aside is
solved by the revised simplex method; new patterns come from a knapsack dynamic program
over the dual prices. Its solution is rounded to whole sequences, and the pieces, ranked
within their length, are assigned to the places of the patterns. The documents set
aside and those that rounding leaves (less than a sequence for each pattern) are put
end to end and cut where a gap, and behind the gaps a sequence, is full; the last rest
is cut into powers of two.

Only the histogram reaches the driver, and only the plan (rows for each pattern and
length, and for each gap) is broadcast; both are bounded by ``size``. Ranks are counted
by the encoding tasks and summed over tasks, and places follow from ranks by arithmetic,
so no length is gathered in one place and each text is encoded once.

Cases: a null or empty text has the end id only; texts of any length are encoded whole;
the string of a special token gives its id, as in the tokenizers library with default
settings; repeated rows are packed as often as they are there, and null ids like
others; an empty table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.bpe import DEFAULT_VOCABULARY, byte_alphabet
from tidelog.llm.common import materialize
from tidelog.storage import ship_package, small_table

SIZE, END_ID = 1024, 0
# What a cut costs, in tokens of padding: smaller gaps are padded.
CUT = 4
# The program ends within this of its bound; pivots between two knapsacks and new inverses.
GAP, PIVOTS, REFRESH, ROUNDS = 5e-4, 200, 200, 12
EPS = 1e-9
# Filled patterns that a knapsack gives at most.
FILLED = 64
# Patterns of the first basis that use the same knapsack.
STARTS = 16
# Pieces that a task gives at a time.
ROWS = 20_000

PLACES = "length int, low long, high long, per int, base long, place int"
STREAM = "length int, low long, at long"


def padded(length: int, size: int) -> int:
    """What a sequence of this length takes: itself if a power of two, else ``size``."""
    return length if length & (length - 1) == 0 else size


# --- the linear program ---------------------------------------------------------
#
# A row for each length (how many pieces there are) and one for the filling: a document
# set aside gives its length to it, a filled pattern takes its gap from it.


def knapsack(lengths: np.ndarray, prices: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Best price of a set of pieces of exactly each total, and the last piece (its index) taken."""
    best = np.full(size + 1, -np.inf)
    taken = np.full(size + 1, -1)
    best[0] = 0.0
    useful = np.flatnonzero(prices > EPS)
    long, price = lengths[useful], prices[useful]
    fitting = np.searchsorted(long, np.arange(size + 1), side="right")
    for total in range(1, size + 1):
        if n := fitting[total]:
            values = best[total - long[:n]] + price[:n]
            k = int(values.argmax())
            if values[k] > -np.inf:
                best[total], taken[total] = values[k], useful[k]
    return best, taken


def priced(lengths: np.ndarray, duals: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns that cost less than their rows are priced at, and their costs."""
    m = len(lengths)
    prices, filling = duals[:m], duals[m]
    best, taken = knapsack(lengths, prices, size)
    totals = np.arange(size + 1)
    # The best total up to each room.
    at = np.maximum.accumulate(np.where(best == np.maximum.accumulate(best), totals, 0))
    powers = [1 << k for k in range(size.bit_length()) if 1 << k <= size]
    closed = {(int(at[size - n]), i) for i, n in enumerate(lengths)}
    closed |= {(size - int(n), i) for i, n in enumerate(lengths) if best[size - n] > -np.inf}
    closed |= {(p, -1) for p in powers if best[p] > -np.inf}
    reduced = totals + CUT - best + filling * (size - totals)
    filled = [int(t) for t in np.argsort(reduced)[:FILLED] if t < size and reduced[t] < -EPS]
    found: dict[bytes, tuple[np.ndarray, float]] = {}

    def offer(total: int, extra: int, fill: bool) -> None:
        column = np.zeros(m + 1)
        room = total
        while room:
            column[taken[room]] += 1
            room -= int(lengths[taken[room]])
        if extra >= 0:
            column[extra] += 1
            total += int(lengths[extra])
        cost = total + CUT if fill else padded(total, size)
        column[m] = total - size if fill else 0
        if cost - duals @ column < -1e-7 * size:
            found[column.tobytes()] = column, cost

    for total, extra in closed:
        offer(total, extra, False)
    for total in filled:
        offer(total, -1, True)
    for i, n in enumerate(lengths.tolist()):
        if n - prices[i] - filling * n < -1e-7 * size:
            column = np.zeros(m + 1)
            column[i], column[m] = 1, n
            found[column.tobytes()] = column, n
    columns = np.array([c for c, _ in found.values()]).reshape(-1, m + 1).T
    return columns, np.array([c for _, c in found.values()], float)


def first_basis(lengths: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """One pattern for each length, by falling length: the longest pieces that are left and what
    fills their sequence best, as often as there is enough. Each use exhausts a length
    that later patterns do without, so the patterns are independent."""
    m = len(lengths)
    left, open_ = counts.astype(float), np.ones(m, bool)
    basis = np.diag((size // lengths).astype(float))
    while open_.any():
        # Of fillings of equal total the one with the most plentiful lengths.
        plenty = np.log1p(left) / (1 + np.log1p(left).max())
        best, taken = knapsack(lengths, np.where(open_, lengths * (1 + 1e-3 * plenty), 0.0), size)
        at = np.maximum.accumulate(np.where(best == np.maximum.accumulate(best), np.arange(size + 1), 0))
        for i in np.flatnonzero(open_)[::-1][:STARTS].tolist():
            column = np.zeros(m)
            column[i], room = 1, int(at[size - lengths[i]])
            while room:
                column[taken[room]] += 1
                room -= int(lengths[taken[room]])
            used = np.flatnonzero(column)
            if not open_[used].all():
                continue
            times = (left[used] / column[used]).min()
            left[used] -= times * column[used]
            gone = used[left[used] <= 1e-7 * counts[used]]
            basis[:, gone[0]] = column
            left[gone], open_[gone] = 0.0, False
    return basis


def solve(lengths: np.ndarray, counts: np.ndarray, size: int) -> list[tuple[np.ndarray, float]]:
    """Columns and how often each is used (not whole) so that all pieces are in one, at least cost.

    Every step keeps the uses positive, so the solution may be taken at any time.
    """
    m = len(lengths)
    demand = np.append(counts, 0).astype(float)
    basis = np.zeros((m + 1, m + 1))
    basis[:m, :m], basis[m, m] = first_basis(lengths, counts, size), -size
    costs = np.append([padded(int(t), size) for t in lengths @ basis[:m, :m]], CUT).astype(float)

    def refreshed() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inverse = np.linalg.inv(basis)
        return inverse, np.maximum(inverse @ demand, 0.0), costs @ inverse

    inverse, uses, duals = refreshed()
    bound, since = float(lengths @ counts), 0
    for _ in range(ROUNDS):
        if float(costs @ uses) <= bound * (1 + GAP):
            break
        columns, prices = priced(lengths, duals, size)
        if not len(prices):
            break
        for _ in range(PIVOTS):
            reduced = prices - duals @ columns
            j = int(reduced.argmin())
            if reduced[j] > -1e-7 * size:
                break
            column = columns[:, j]
            used = np.flatnonzero(column)
            direction = inverse[:, used] @ column[used]
            rising = direction > EPS
            if not rising.any():
                break
            steps = np.where(rising, uses / np.where(rising, direction, 1.0), np.inf)
            step = steps.min()
            # Of equal steps the largest pivot is the most stable one.
            row = int(np.where(steps <= step + EPS, direction, -np.inf).argmax())
            uses = np.maximum(uses - step * direction, 0.0)
            uses[row] = step
            inverse[row] /= direction[row]
            direction[row] = 0.0
            inverse -= np.outer(direction, inverse[row])
            duals = duals + reduced[j] * inverse[row]
            basis[:, row], costs[row] = column, prices[j]
            since += 1
            if since % REFRESH == 0:
                inverse, uses, duals = refreshed()
        inverse, uses, duals = refreshed()
    return [(basis[:, i].astype(int), float(uses[i])) for i in range(m + 1)]


@dataclass
class Pattern:
    """Pieces of each length that share a sequence, how often, and the gap to be filled behind them."""

    pieces: np.ndarray
    times: int
    gap: int


def rounded(lengths: np.ndarray, counts: np.ndarray, size: int) -> tuple[list[Pattern], np.ndarray]:
    """Whole uses of patterns, and the pieces that are left to be cut.

    Uses are rounded down; then each pattern, by falling fraction, is used once more if
    its pieces are still there and enough is left for the gaps.
    """
    left = counts.astype(np.int64).copy()
    if not len(lengths):
        return [], left
    chosen, gaps = [], 0
    for column, use in solve(lengths, counts, size):
        pieces, filling = column[:-1], int(column[-1])
        if filling > 0 or not pieces.any():
            continue
        taken = pieces > 0
        # Rounding errors of the program must not take a piece that is not there.
        times = min(int(use + 1e-6), int((left[taken] // pieces[taken]).min()))
        chosen.append((Pattern(pieces, times, -filling), use - times))
        left -= times * pieces
        gaps += times * -filling
    rest = int(left @ lengths)
    for pattern, fraction in sorted(chosen, key=lambda c: -c[1]):
        total = int(pattern.pieces @ lengths)
        if fraction > 0.05 and (left >= pattern.pieces).all() and rest - total >= gaps + pattern.gap:
            pattern.times += 1
            left -= pattern.pieces
            rest, gaps = rest - total, gaps + pattern.gap
    return [pattern for pattern, _ in chosen if pattern.times], left


@dataclass
class Plan:
    """Where pieces go.

    ``places`` (rows of ``PLACES``): pieces of ``length`` with a rank from ``low`` to below ``high`` go
    ``per`` to a sequence, from ``base`` on, the first one at ``place``. ``stream`` (rows of
    ``STREAM``): pieces from the rank ``low`` on are put end to end from ``at``. ``gaps``
    (columns): what the stream fills, by its first token: room, sequence and place of the
    first of a run of equal gaps in neighbouring sequences.
    """

    places: list[tuple]
    stream: list[tuple]
    gaps: np.ndarray


def plan(histogram: dict[int, int], size: int) -> Plan:
    lengths = np.array(sorted(n for n in histogram if n < size), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    base = histogram.get(size, 0)
    places, gaps, filled = ([(size, 0, base, 1, 0, 0)] if base else []), [], 0
    patterns, left = rounded(lengths, counts, size)
    ranked = np.zeros(len(lengths), np.int64)
    for pattern in patterns:
        place = 0
        for i in np.flatnonzero(pattern.pieces)[::-1].tolist():
            n, each, low = int(lengths[i]), int(pattern.pieces[i]), int(ranked[i])
            places.append((n, low, low + each * pattern.times, each, base, place))
            ranked[i] += each * pattern.times
            place += each * n
        if pattern.gap:
            gaps.append((filled, pattern.gap, base, place))
            filled += pattern.gap * pattern.times
        base += pattern.times
    stream, at = [], 0
    for i in reversed(range(len(lengths))):
        if left[i]:
            stream.append((int(lengths[i]), int(ranked[i]), at))
            at += int(left[i] * lengths[i])
    # Behind the gaps come whole sequences and, for the last rest, powers of two.
    rest = at - filled
    if rest >= size:
        gaps.append((filled, size, base, 0))
        filled, base = filled + rest // size * size, base + rest // size
    for k in reversed(range(size.bit_length() - 1)):
        if rest > 0 and rest % size >> k & 1:
            gaps.append((filled, 1 << k, base, 0))
            filled, base = filled + (1 << k), base + 1
    return Plan(places, stream, np.array(gaps, np.int64).reshape(-1, 4).T)


def cuts(gaps: np.ndarray, at: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Parts of a piece that lies ``at`` in the stream: ``start, length, sequence, offset``."""
    start = 0
    while start < length:
        run = int(np.searchsorted(gaps[0], at + start, side="right")) - 1
        first, room, sequence, place = gaps[:, run].tolist()
        nth, inside = divmod(at + start - first, room)
        part = min(length - start, room - inside)
        yield start, part, sequence + nth, place + inside
        start += part


# --- encoding -------------------------------------------------------------------


def encoding_of(text: str) -> tiktoken.Encoding:
    """The byte-level BPE of a vocabulary file whose merges are ranked by the ids that they make."""
    data = json.loads(text)
    stands, ids = byte_alphabet(), data["model"]["vocab"]
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    merges = data["model"]["merges"]
    made = [ids["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in merges]
    if any(a >= b for a, b in zip(made, made[1:])):
        raise ValueError("the merges of this vocabulary are not in the order of their ids")
    ranks = {bytes(stands[c] for c in token): i for token, i in ids.items() if token not in special}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def _ids(encoding: tiktoken.Encoding, text: str | None) -> np.ndarray:
    ids = encoding.encode_to_numpy(text, allowed_special="all") if text else np.zeros(0, np.uint32)
    return np.append(ids, np.uint32(END_ID)).astype("<u4")


def _load(path: str | None) -> str:
    with open(path or public_tokenizers.path(DEFAULT_VOCABULARY), encoding="utf-8") as file:
        return file.read()


def _pieces(docs: DataFrame, key: str, size: int, vocabulary) -> DataFrame:
    """A row for each piece, with its task and its rank among the pieces of its length there.
    Pieces that may be cut again keep their ids."""
    chosen = docs.select(key, "text")
    numbers = [("start", T.LongType()), ("length", T.IntegerType()), ("ids_crc32", T.LongType()), ("doc_tokens", T.LongType()),
               ("task", T.IntegerType()), ("nth", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([chosen.schema[key], *[T.StructField(n, t) for n, t in numbers]])
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, task = None, TaskContext.get().partitionId()
        seen = [0] * (size + 1)

        def made(keys: pa.Array, places: list[int], rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays([keys.take(pa.array(places, pa.int64())), *columns], names=schema.names)

        for batch in batches:
            encoding = encoding or encoding_of(vocabulary.value)
            places, rows = [], []
            for k, text in enumerate(batch.column(1)):
                ids = _ids(encoding, text.as_py())
                raw, n = ids.tobytes(), len(ids)
                for start in range(0, n, size):
                    length = min(size, n - start)
                    part = raw[4 * start:4 * (start + length)]
                    places.append(k)
                    rows.append((start, length, zlib.crc32(part), n, task, seen[length], part if length < size else None))
                    seen[length] += 1
                    if len(rows) == ROWS:
                        yield made(batch.column(0), places, rows)
                        places, rows = [], []
            if rows:
                yield made(batch.column(0), places, rows)

    return chosen.mapInArrow(work, schema)


# --- assignment -----------------------------------------------------------------


def _cut(pieces: DataFrame, key: str, gaps: np.ndarray) -> DataFrame:
    """Parts of the pieces of the stream, with their places."""
    schema = T.StructType([pieces.schema[key], *[T.StructField(n, T.LongType()) for n in RESULT]])
    chosen = pieces.select(key, "start", "doc_tokens", "at", "ids")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = [], []
            starts, tokens, positions = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for k, raw in enumerate(batch.column(4)):
                ids = raw.as_py()
                for start, length, sequence, offset in cuts(gaps, positions[k], len(ids) // 4):
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    places.append(k)
                    rows.append((starts[k] + start, length, crc, tokens[k], sequence, offset))
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), *columns], names=schema.names)

    return chosen.mapInArrow(work, schema)


RESULT = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_OWN = [*RESULT, "task", "nth", "ids", "earlier", "rank", "at", "low", "high", "per", "base", "place"]


def pack(docs: DataFrame, key: str = "doc_id", size: int = SIZE, path: str | None = None) -> DataFrame:
    """Pieces of all documents (``key``, ``text``) and where they lie: ``key``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    if size < 2 or size & (size - 1):
        raise ValueError("the size of a sequence must be a power of two")
    spark = docs.sparkSession
    ship_package(spark)
    # A vocabulary file has a fixed size; the driver reads it, executors need no file.
    vocabulary = spark.sparkContext.broadcast(_load(path))
    own = "_doc" if key in _OWN else key
    pieces = materialize(_pieces(docs.select(F.col(key).alias(own), "text"), own, size, vocabulary), "pack-pieces")

    # Pieces of a length that earlier tasks have: a row for each task and length.
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = materialize(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    earlier = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = plan(histogram, size)
    ranked = pieces.join(earlier, ["length", "task"]).withColumn("rank", F.col("nth") + F.col("earlier"))

    # Both sides of the plan have rows for each pattern and length: their size depends on ``size`` only.
    k = F.col("rank") - F.col("low")
    whole = (
        ranked.join(F.broadcast(small_table(spark, made.places, PLACES)), "length")
        .filter((F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
        .withColumn("sequence_id", F.col("base") + F.floor(k / F.col("per")).cast("long"))
        .withColumn("offset", (F.col("place") + F.pmod(k, F.col("per")) * F.col("length")).cast("long"))
        .withColumn("length", F.col("length").cast("long"))
        .select(own, *RESULT)
    )
    streamed = (
        ranked.join(F.broadcast(small_table(spark, made.stream, STREAM)), "length").filter(F.col("rank") >= F.col("low"))
        .withColumn("at", F.col("at") + k * F.col("length"))
    )
    return whole.unionByName(_cut(streamed, own, made.gaps)).withColumnRenamed(own, key)
