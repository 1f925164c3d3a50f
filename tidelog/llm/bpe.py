"""Byte-level BPE by a pair occurrence index.

A task cuts its texts into pre-tokens and merges those that it has not met yet, many
at a time: an index maps every adjacent pair of symbols to all its positions, the
active ranks are taken in ascending order, each is applied at all its positions from
left to right, and the lists of the pairs that this makes are extended. A known
pre-token is looked up. Rows never leave their task.

Cases: a null text is encoded like an empty one (no ids); texts and pre-tokens of any
length are encoded whole; the string of a special token gives its id, as in the
tokenizers library with default settings; rows are independent, so repeated rows
and null or repeated ids do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidelog.storage import ship_package

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
# Known pre-tokens per task, and new pre-tokens that are merged together.
CACHE, BLOCK = 450_000, 20_000
# Characters of text that are cut into pre-tokens at a time.
SLICE_CHARS = 1 << 20
PAIR = 1 << 32


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes: visible Latin-1 characters stand for
    themselves, the other bytes for characters from 256 on, in order."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Merges, byte values and special tokens of a byte-level BPE file."""

    def __init__(self, text: str):
        data = json.loads(text)
        stands = byte_alphabet()
        ids: dict[str, int] = data["model"]["vocab"]
        self.of_id = {i: bytes(stands[c] for c in token) for token, i in ids.items()}
        self.byte_ids = [0] * 256
        for i, value in self.of_id.items():
            if len(value) == 1:
                self.byte_ids[value[0]] = i
        # Pair of ids (as one number) to its rank and the id of the merged token.
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.merges.setdefault(ids[a] * PAIR + ids[b], (rank, ids[a + b]))
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.of_id |= {i: s.encode() for s, i in self.special.items()}


def merge_words(words: list[str], vocabulary: Vocabulary) -> list[bytes]:
    """Ids of each word, as little-endian unsigned 32-bit integers."""
    merges, byte_ids = vocabulary.merges, vocabulary.byte_ids
    symbols: list[int] = [-1]
    bounds = []
    for word in words:
        symbols.extend([byte_ids[b] for b in word.encode()])
        bounds.append(len(symbols))
        symbols.append(-1)
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    positions: dict[int, list[int]] = {}
    flat = np.array(symbols, np.int64)
    # Pairs of neighbours; a pair with a separator is no merge.
    for p, pair in enumerate((flat[:-1] * PAIR + flat[1:]).tolist()):
        if pair in merges:
            if pair in positions:
                positions[pair].append(p)
            else:
                positions[pair] = [p]
    ranks = [(merges[pair][0], pair) for pair in positions]
    heapq.heapify(ranks)
    while ranks:
        _, pair = heapq.heappop(ranks)
        a, b = divmod(pair, PAIR)
        made = merges[pair][1]
        for p in sorted(positions.pop(pair)):
            # A position may have been merged away since it was listed.
            if symbols[p] != a:
                continue
            q = after[p]
            if symbols[q] != b:
                continue
            symbols[p], symbols[q] = made, -2
            r, o = after[q], before[p]
            after[p], before[r] = r, p
            if (left := symbols[o]) >= 0 and (new := left * PAIR + made) in merges:
                if new in positions:
                    positions[new].append(o)
                else:
                    positions[new] = [o]
                    heapq.heappush(ranks, (merges[new][0], new))
            if (right := symbols[r]) >= 0 and (new := made * PAIR + right) in merges:
                if new in positions:
                    positions[new].append(p)
                else:
                    positions[new] = [p]
                    heapq.heappush(ranks, (merges[new][0], new))
    flat = np.array(symbols, np.int64)
    alive = flat >= 0
    ids = flat[alive].astype("<u4").tobytes()
    ends = np.cumsum(alive)[bounds] * 4
    starts = [0, *ends[:-1].tolist()]
    return [ids[s:e] for s, e in zip(starts, ends.tolist())]


class Encoder:
    """Encodes texts of one task and remembers the pre-tokens that it has merged."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.cut = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, bytes] = {}
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None

    def _pieces(self, text: str) -> list[str]:
        return self.split(text) if self.split else [text]

    def _learn(self, words: set[str]) -> None:
        new = sorted(w for w in words if w not in self.known)
        if len(self.known) + len(new) > CACHE:
            self.known = {}
            new = sorted(words)
        for k in range(0, len(new), BLOCK):
            block = new[k:k + BLOCK]
            self.known.update(zip(block, merge_words(block, self.vocabulary)))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut, special = self.cut, self.vocabulary.special
        texts_pieces = [
            [piece if k % 2 else cut(piece) for k, piece in enumerate(self._pieces(text))] for text in texts
        ]
        self._learn({w for pieces in texts_pieces for piece in pieces[::2] for w in piece})
        known = self.known.__getitem__
        return [
            b"".join(
                special[piece].to_bytes(4, "little") if k % 2 else b"".join(map(known, piece))
                for k, piece in enumerate(pieces)
            )
            for pieces in texts_pieces
        ]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.vocabulary.of_id.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(
            "utf-8", "replace"
        )


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in order, in slices of about ``SLICE_CHARS``; a longer text is a slice of its own."""
    part, size = [], 0
    for value in texts:
        text = value.as_py() or ""
        if part and size + len(text) > SLICE_CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _load(path: str | None) -> str:
    with open(path or public_tokenizers.path(DEFAULT_VOCABULARY), encoding="utf-8") as file:
        return file.read()


def encode_texts(docs: DataFrame, keys: list[str], path: str | None = None) -> DataFrame:
    """``keys``, ``n_tokens``, ``ids`` (array), ``round_trip`` (decoding gives the text back)."""

    def rows(encoder: Encoder, texts: list[str]) -> Iterator[tuple]:
        for text, ids in zip(texts, encoder.encode(texts)):
            numbers = np.frombuffer(ids, "<u4").astype(np.int32)
            yield len(numbers), numbers, encoder.decode(ids) == text

    fields = [("n_tokens", T.LongType()), ("ids", T.ArrayType(T.IntegerType())), ("round_trip", T.BooleanType())]
    return _map(docs, keys, path, fields, rows)


def digest_texts(docs: DataFrame, keys: list[str], path: str | None = None) -> DataFrame:
    """``keys``, ``n_tokens`` and the SHA-256 of the ids and of the decoded text."""

    def rows(encoder: Encoder, texts: list[str]) -> Iterator[tuple]:
        for ids in encoder.encode(texts):
            decoded = encoder.decode(ids).encode()
            yield len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    fields = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return _map(docs, keys, path, fields, rows)


def _map(docs: DataFrame, keys: list[str], path: str | None, fields: list[tuple], rows) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    # A vocabulary file has a fixed size; the driver reads it, executors need no file.
    vocabulary = spark.sparkContext.broadcast(_load(path))
    chosen = docs.select(*keys, "text")
    schema = T.StructType([*[chosen.schema[k] for k in keys], *[T.StructField(n, t) for n, t in fields]])
    types = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_(),
             T.ArrayType(T.IntegerType()): pa.list_(pa.int32())}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(Vocabulary(vocabulary.value))
            done = 0
            for texts in _slices(batch.column(len(keys))):
                # Copies of a text are encoded once.
                different = list(dict.fromkeys(texts))
                found = dict(zip(different, rows(encoder, different)))
                columns = list(zip(*map(found.__getitem__, texts)))
                part = batch.slice(done, len(texts))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keys)], *[pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)]],
                    names=schema.names,
                )

    return chosen.mapInArrow(work, schema)
