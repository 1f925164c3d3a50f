"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

A word (run of letters, lower case, with a mark in front) may be cut into pieces of the
vocabulary in many ways. A forward pass sums the probability of all of them; the
score of a text under a language is the sum of the logarithms of its words. The
probabilities of the pieces are learned per language by expected counts (forward and
backward) of all segmentations of all training words, in one pass under equal weights.

Tasks add up expected counts per language and piece before anything is shuffled, so
what is gathered has one row per language, piece and task, whatever the text; a task
that meets more than ``AT_ONCE`` languages hands its sums over in between. The counts
stay sparse and go to the executors in chunks of ``AT_ONCE`` languages. One chunk at a
time is expanded to a number per language and piece, and every text keeps its best
language and its sum of probabilities from chunk to chunk, so any number of languages
works. The driver holds one chunk, the names of the languages and the pieces.

Cases: ``und`` with score 0 if a text is null or has no letter, or nothing was
learned; equal scores go to the smaller language name; training rows without text or
language are skipped; a letter outside the vocabulary is a piece of its own with the
same small weight everywhere; combining marks belong to the word of their letter; runs
of any length are summed over all segmentations, with sums rescaled on the way;
texts are read whole; repeated rows count as often as they occur; an empty table
gives no rows; other columns are kept.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import materialize
from tidelog.storage import ship_package

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
UNDETERMINED = "und"
MARK = "▁"
# Letters between two rescalings of the sums, and places of words that need none.
RESCALE, SHORT = 4, 16
# Known words per task, words that are worked on together, characters per slice.
CACHE, BLOCK, SLICE_CHARS = 400_000, 20_000, 1 << 20
# Languages that are worked on together, and numbers that a task holds for them at most.
AT_ONCE, CELLS = 128, 1 << 23
# Weight of a letter outside the vocabulary, and of the common share in every language.
UNKNOWN, COMMON = 1e-7, 100.0

find_letters = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
is_letters = regex.compile(r"[\p{L}\p{M}]+").fullmatch


def load_pieces(path: str | None = None) -> list[str]:
    """Pieces of the vocabulary that consist of letters (and the mark in front)."""
    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(DEFAULT_VOCABULARY))
    pieces = {model.id_to_piece(i) for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p == MARK or is_letters(p.removeprefix(MARK)))


def words_of(text: str) -> list[str]:
    return find_letters(text.lower())


def by_length(words: set[str]) -> list[str]:
    return sorted(words, key=lambda w: (len(w), w))


def blocks(words: list[str], most: int, columns: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of words (by rising length) with their start: ``most`` words, and no more places
    in all, columns counted, than ``CELLS``; one word at least."""
    start = 0
    while start < len(words):
        end = min(len(words), start + most)
        while end > start + 1 and (len(words[end - 1]) + 2) * (end - start) * columns > CELLS:
            end = start + max(1, (end - start) // 2)
        yield start, words[start:end]
        start = end


class Trie:
    """Pieces as a tree: an edge is a node and a character, in one sorted array."""

    def __init__(self, pieces: list[str]):
        nodes = {"": 0}
        edges, children = [], []
        for piece in pieces:
            for n in range(1, len(piece) + 1):
                if piece[:n] not in nodes:
                    nodes[piece[:n]] = len(nodes)
                    edges.append(nodes[piece[:n - 1]] << 21 | ord(piece[n - 1]))
                    children.append(nodes[piece[:n]])
        order = np.argsort(np.array(edges, np.int64))
        self.edges = np.append(np.array(edges, np.int64)[order], np.iinfo(np.int64).max)
        self.children = np.append(np.array(children, np.int64)[order], 0)
        # Number of the piece that ends in a node, -1 if none does.
        self.piece = np.full(len(nodes), -1, np.int64)
        self.piece[[nodes[p] for p in pieces]] = np.arange(len(pieces))
        self.unknown = len(pieces)

    def step(self, states: np.ndarray, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which states have the next character, and where it leads them."""
        wanted = states << 21 | characters
        at = np.searchsorted(self.edges, wanted)
        there = self.edges[at] == wanted
        return there, self.children[at[there]]


class Lattice:
    """All pieces that occur in some words, each with a mark in front.

    Pieces are held in runs of equal length and start, so that a word occurs once in a
    run at most. Sums over long words leave the range of numbers, so every few letters
    those that are still needed are divided by the largest one; the logarithms of the
    divisors are kept per place.
    """

    def __init__(self, words: list[str], trie: Trie):
        parts = [MARK + word for word in words]
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.width = int(self.lengths.max()) + 1
        characters = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(parts)), self.lengths)
        begin = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(characters)) - begin[owner]
        self.runs: list[tuple[int, int, slice]] = []
        found, size, done = [], 1, 0
        at, states = np.arange(len(characters)), np.zeros(len(characters), np.int64)
        while len(at):
            there, states = trie.step(states, characters[at + size - 1])
            if size == 1:
                piece = np.full(len(at), -1, np.int64)
                piece[there] = trie.piece[states]
                piece[piece < 0] = trie.unknown
                chosen, at = at, at[there]
            else:
                at = at[there]
                piece = trie.piece[states]
                ends = piece >= 0
                chosen, piece = at[ends], piece[ends]
            order = np.argsort(place[chosen].astype(np.uint8 if self.width < 256 else np.int32), kind="stable")
            chosen, piece = chosen[order], piece[order]
            counts = np.bincount(place[chosen], minlength=self.width)
            for start in np.flatnonzero(counts).tolist():
                self.runs.append((start, start + size, slice(done, done + int(counts[start]))))
                done += int(counts[start])
            found.append((owner[chosen], piece))
            inside = place[at] + size < self.lengths[owner[at]]
            at, states, size = at[inside], states[inside], size + 1
        # No piece here is longer, so sums further back are not needed again.
        self.reach = max((end - start for start, end, _ in self.runs), default=1)
        self.word = np.concatenate([f[0] for f in found])
        self.piece = np.concatenate([f[1] for f in found])

    def _sums(self, sums: np.ndarray, steps: list[tuple[int, int, slice]], weights: np.ndarray, forward: bool) -> np.ndarray | None:
        """Add up ``sums`` (place, word, column) run by run; the logarithms of the divisors per place."""
        if self.width <= SHORT:
            for a, b, run in steps:
                w = self.word[run]
                sums[b, w] += sums[a, w] * weights[self.piece[run]]
            return None
        scales, total, last = np.zeros(sums.shape), np.zeros(sums.shape[1:]), steps[0][1]
        for a, b, run in steps:
            if abs(b - last) >= RESCALE:
                # Sums before ``b`` are complete; these may still be used, and have one scale.
                near = slice(max(0, last - self.reach + 1), b) if forward else slice(b + 1, last + self.reach)
                top = sums[near].max(axis=0)
                top[top <= 0] = 1.0
                sums[near] /= top
                total += np.log(top)
                scales[near] = total
                last = b
            w = self.word[run]
            sums[b, w] += sums[a, w] * weights[self.piece[run]]
        scales[slice(last, None) if forward else slice(0, last + 1)] = total
        return scales

    def forward(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Sums over all segmentations of every prefix; ``weights`` has a row per piece."""
        alpha = np.zeros((self.width, len(self.lengths), weights.shape[1]))
        alpha[0] = 1.0
        return alpha, self._sums(alpha, sorted(self.runs, key=lambda r: r[1]), weights, True)

    def _ends(self, alpha: np.ndarray, scales: np.ndarray | None) -> np.ndarray:
        at = self.lengths, np.arange(len(self.lengths))
        return np.log(alpha[at]) + (0.0 if scales is None else scales[at])

    def logs(self, weights: np.ndarray) -> np.ndarray:
        """Logarithm of each word's probability, one column per weight column."""
        return self._ends(*self.forward(weights))

    def expected(self, weights: np.ndarray) -> np.ndarray:
        """Probability that a piece is used at its place, one column per weight column."""
        alpha, scales = self.forward(weights)
        beta = np.zeros_like(alpha)
        beta[self.lengths, np.arange(len(self.lengths))] = 1.0
        back = sorted(((end, start, run) for start, end, run in self.runs), key=lambda r: -r[1])
        behind = self._sums(beta, back, weights, False)
        total = self._ends(alpha, scales)
        share = np.empty((len(self.word), weights.shape[1]))
        for start, end, run in self.runs:
            w = self.word[run]
            scale = -total[w] if scales is None else scales[start, w] + behind[end, w] - total[w]
            share[run] = alpha[start, w] * weights[self.piece[run]] * beta[end, w] * np.exp(scale)
        return share


def _slices(texts: Iterator[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


class Weights:
    """Weights of the pieces for one chunk of languages after the other.

    ``shared`` has a broadcast for each chunk: pieces, columns and expected counts.
    """

    def __init__(self, everywhere: np.ndarray, totals: list[np.ndarray], shared: list):
        self.everywhere, self.totals, self.shared = everywhere, totals, shared

    def __len__(self) -> int:
        return len(self.shared)

    def __getitem__(self, k: int) -> np.ndarray:
        piece, column, n = self.shared[k].value
        if len(self.shared) > 1:
            # A broadcast keeps what it has read; the next access reads it again.
            self.shared[k].__dict__.pop("_value", None)
        counts = np.zeros((len(self.everywhere) + 1, len(self.totals[k])))
        counts[piece, column] = n
        return _weights(counts, self.everywhere, self.totals[k])


class Model:
    """Languages in order of their names, pieces, and one row of probabilities per piece,
    as an array or as ``Weights``."""

    def __init__(self, languages: list[str], pieces: list[str], weights: np.ndarray | Weights):
        self.languages, self.pieces, self.weights = languages, pieces, weights

    def chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        """Number of the first language and weights of each chunk."""
        start = 0
        for k in range(len(self.weights) if isinstance(self.weights, Weights) else bool(self.languages)):
            weights = self.weights[k] if isinstance(self.weights, Weights) else self.weights
            yield start, weights
            start += weights.shape[1]


def fit(docs: DataFrame, path: str | None = None) -> Model:
    """Learn from ``text`` and ``lang`` of all rows that have both."""
    spark = docs.sparkSession
    ship_package(spark)
    pieces = load_pieces(path)
    shared = spark.sparkContext.broadcast(pieces)
    at_once = AT_ONCE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(shared.value)
        trie = Trie(shared.value)
        equal = np.append(np.full(n, 1.0 / max(1, n)), UNKNOWN)[:, None]
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(n + 1))
        words: dict[str, Counter] = defaultdict(Counter)
        held = 0

        def hand_over() -> Iterator[pa.RecordBatch]:
            for lang, values in sums.items():
                used = np.flatnonzero(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(values[used])],
                    names=["lang", "piece", "n"],
                )
            sums.clear()

        def settle() -> Iterator[pa.RecordBatch]:
            different = by_length(set().union(*words.values()))
            number = dict(zip(different, range(len(different))))
            known = {}
            for lang, counts in words.items():
                rows = np.fromiter(map(number.__getitem__, counts), np.int64, len(counts))
                order = np.argsort(rows)
                known[lang] = rows[order], np.fromiter(counts.values(), np.float64, len(counts))[order]
            words.clear()
            for k, block in blocks(different, BLOCK, 4):
                lattice = Lattice(block, trie)
                share = lattice.expected(equal)[:, 0]
                owner = lattice.word
                # The places of each word in the lattice, so that a language reads those of its words only.
                order = np.argsort(owner, kind="stable")
                first = np.searchsorted(owner[order], np.arange(len(block) + 1))
                for lang, (rows, times) in known.items():
                    here = slice(*np.searchsorted(rows, [k, k + len(block)]))
                    row = rows[here] - k
                    if not len(row):
                        continue
                    if lang not in sums and len(sums) >= at_once:
                        yield from hand_over()
                    size = first[row + 1] - first[row]
                    place = order[np.repeat(first[row] - np.cumsum(size) + size, size) + np.arange(size.sum())]
                    sums[lang] += np.bincount(lattice.piece[place], share[place] * np.repeat(times[here], size), n + 1)

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                found = words_of(text.as_py())
                if not found:
                    continue
                counts = words[lang.as_py()]
                held -= len(counts)
                counts.update(found)
                held += len(counts)
                if held > CACHE:
                    yield from settle()
                    held = 0
        if words:
            yield from settle()
        yield from hand_over()

    usable = docs.select(F.col("lang").cast("string"), "text").filter("lang is not null and text is not null")
    counts = materialize(
        usable.mapInArrow(count, "lang string, piece long, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")),
        "language-pieces",
    )
    everywhere = np.zeros(len(pieces))
    known = counts.filter(F.col("piece") < len(pieces))
    by_piece = known.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()
    everywhere[by_piece.column("piece").to_numpy()] = by_piece.column("n").to_numpy()
    # A language may have letters outside the vocabulary only.
    inside = F.sum(F.when(F.col("piece") < len(pieces), F.col("n")).otherwise(0.0))
    total = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(inside.alias("n")).collect()}
    languages = sorted(total)
    totals, parts = [], []
    for k in range(0, len(languages), AT_ONCE):
        names = languages[k:k + AT_ONCE]
        column = {lang: c for c, lang in enumerate(names)}
        # Names are ordered alike here and in Spark: by code points.
        chunk = counts.filter(F.col("lang").between(names[0], names[-1])).toArrow()
        columns = np.array([column[x] for x in chunk.column("lang").to_pylist()], np.int64)
        parts.append(spark.sparkContext.broadcast((chunk.column("piece").to_numpy(), columns, chunk.column("n").to_numpy())))
        totals.append(np.array([total[lang] for lang in names]))
    return Model(languages, pieces, Weights(everywhere, totals, parts))


def _weights(counts: np.ndarray, everywhere: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Probabilities of the pieces, smoothed by their share in all languages and a floor."""
    share = (everywhere + 1.0)[:, None]
    share /= share.sum()
    weights = (counts[:-1] + COMMON * share) / (totals + COMMON)
    return np.vstack([weights, np.full((1, counts.shape[1]), UNKNOWN)])


class Scorer:
    """Scores texts of one task and remembers the words that it has met, as long as all
    languages are in one chunk. With ``background``, every chunk has one more column: equal
    weights for all pieces, which stand for text of no language."""

    def __init__(self, model: Model, background: bool = False):
        self.model, self.background = model, background
        self.trie = Trie(model.pieces)
        self.weights = self.chunk = None
        self._reset(0)

    def _reset(self, languages: int) -> None:
        self.row: dict[str, int] = {}
        self.logs = np.zeros((0, languages))

    def _learn(self, words: set[str]) -> None:
        languages = self.weights.shape[1]
        new = by_length({w for w in words if w not in self.row})
        if len(self.row) + len(new) > min(CACHE, CELLS // languages):
            self._reset(languages)
            new = by_length(words)
        parts = [self.logs]
        # The lattice has a column per language.
        step = max(1, 4 * BLOCK // max(4, languages))
        for _, block in blocks(new, step, 2 * languages):
            parts.append(Lattice(block, self.trie).logs(self.weights))
            self.row.update(zip(block, range(len(self.row), len(self.row) + len(block))))
        self.logs = np.concatenate(parts)

    def _scores(self, split: list[list[str]]) -> Iterator[np.ndarray | None]:
        """The scores of each text under the languages of the chunk; none if it has no word."""
        self._learn({w for words in split for w in words})
        row, step = self.row.__getitem__, max(1, CELLS // self.weights.shape[1])
        for words in split:
            rows = np.fromiter(map(row, words), np.int64, len(words))
            yield sum(self.logs[rows[k:k + step]].sum(axis=0) for k in range(0, len(rows), step)) if words else None

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and its share of the probability."""
        return [found[:2] for found in self.judge(texts)]

    def judge(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """Language, its share of the probability, and how much better a letter of the text fits
        it than the background (difference of logarithms; 0 without background)."""
        split = [words_of(t) for t in texts]
        # Language, its score, and the sum of all probabilities divided by that of the language.
        best: list[tuple[int, float, float] | None] = [None] * len(split)
        plain = [0.0] * len(split)
        for start, weights in self._chunks():
            if self.chunk is not weights:
                self.chunk = weights
                self.weights = weights
                if self.background:
                    equal = np.append(np.full(len(weights) - 1, 1.0 / max(1, len(weights) - 1)), UNKNOWN)
                    self.weights = np.hstack([weights, equal[:, None]])
                self._reset(self.weights.shape[1])
            for k, scores in enumerate(self._scores(split)):
                if scores is None:
                    continue
                if self.background:
                    plain[k], scores = float(scores[-1]), scores[:-1]
                top = int(np.argmax(scores))
                new = start + top, float(scores[top]), float(np.exp(scores - scores[top]).sum())
                best[k] = new if best[k] is None else _joined(best[k], new)
        out = []
        for b, words, other in zip(best, split, plain):
            if b is None:
                out.append((UNDETERMINED, 0.0, 0.0))
            else:
                fit = (b[1] - other) / sum(map(len, words)) if self.background else 0.0
                out.append((self.model.languages[b[0]], 1.0 / b[2], fit))
        return out

    def _chunks(self) -> Iterator[tuple[int, np.ndarray]]:
        if self.chunk is not None and self.chunk.shape[1] == len(self.model.languages):
            return iter([(0, self.chunk)])
        return self.model.chunks()


def _joined(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    """The better one of two results, the first if they are equal, with the sum of both."""
    if b[1] > a[1]:
        a, b = b, a
    return a[0], a[1], a[2] + b[2] * float(np.exp(b[1] - a[1]))


def predict(docs: DataFrame, model: Model, lang: str, score: str, fit: str | None = None) -> DataFrame:
    """Add the predicted language and its share of the probability (under equal priors), and
    optionally how well the text fits it: the mean, over letters, of the difference of the
    logarithms of its probability and of that under equal weights of all pieces. The share
    says which language it is if it is one of those learned; the fit whether it is one."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((model.languages, model.pieces))
    weights = model.weights
    added = [(lang, T.StringType()), (score, T.DoubleType()), *([(fit, T.DoubleType())] if fit else [])]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in added]])
    text = docs.columns.index("text")
    background = fit is not None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(Model(*shared.value, weights), background)
            texts = (value.as_py() or "" for value in batch.column(text))
            found = [result for part in _slices(texts) for result in scorer.judge(part)]
            columns = [pa.array([f[0] for f in found], pa.string()), *[
                pa.array([f[k] for f in found], pa.float64()) for k in range(1, len(added))]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=schema.names)

    return docs.mapInArrow(work, schema)
