"""Stages of the corpus pipeline: each takes the documents its predecessor kept.

All but the last return the columns of their input. Rows are judged one by one or in
groups of their own content, so null ids, repeated rows and extra columns pass through
as the operators' docstrings say; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, langid, lines, mixing, simhash
from tidelog.llm.common import free_name

# A prediction below this share of the probability is rejected, and one that fits its language
# no better than equal weights of all pieces do: letter noise, or a language that was not learned.
LEAST_SCORE, LEAST_FIT = 0.5, 0.0


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a clear language; ``und``, unclear ones and those that fit no language go.

    Learns from all documents that state a language; if none does, there is no model
    to reject by, and all documents stay.
    """
    model = langid.fit(docs.select("text", "lang"))
    if not model.languages:
        return docs
    lang, score, fit = (free_name(docs, c) for c in ("_lang", "_score", "_fit"))
    judged = langid.predict(docs, model, lang, score, fit)
    clear = (F.col(lang) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE) & (F.col(fit) > LEAST_FIT)
    return judged.filter(clear).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the boilerplate lines of every source; ``n_chars`` follows the text."""
    cleaned = lines.drop_boilerplate(docs, "source")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", length)
    return cleaned.select(*docs.columns)


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_copies(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mix_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    return bpe.encode_texts(docs, ["doc_id"])


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("copies", copies_stage),
    ("mixing", mix_stage),
    ("encoding", encode_stage),
]
