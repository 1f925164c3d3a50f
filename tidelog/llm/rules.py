"""Quality rules: a table of thresholds compiled into one projection.

Per text: length, symbol, stop-word and line statistics, and the words in
repeated windows. Everything is built from SQL functions and needs no shuffle.

Cases: a null or empty text has no words and fails the length rule; rows are
judged one by one, so repeated rows and ids all get their own (equal) result;
null ids pass through; extra columns are ignored; an empty table gives no rows.
A text of any length is judged whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import NOT_BLANK, words_of

WINDOW = 8

# The characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of four languages.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "was", "on", "be", "by", "this", "are",
    # German
    "der", "die", "und", "das", "den", "zu", "mit", "von", "ist", "im", "des", "nicht", "ein", "eine", "für", "sich",
    # French
    "le", "la", "les", "et", "des", "un", "une", "du", "est", "en", "que", "dans", "pour", "qui", "sur", "par",
    # Spanish
    "el", "los", "las", "y", "una", "por", "con", "del", "se", "su", "al", "como", "más", "lo", "es", "para",
)


@dataclass(frozen=True)
class Threshold:
    """A text passes when ``low <= metric <= high``; an open side is None."""

    metric: str
    low: float | None = None
    high: float | None = None

    def failed(self) -> Column:
        value = F.col(self.metric)
        outside = F.lit(False)
        if self.low is not None:
            outside = outside | (value < self.low)
        if self.high is not None:
            outside = outside | (value > self.high)
        return outside


# Metrics are fractions of words, characters or lines.
THRESHOLDS = (
    Threshold("n_words", low=20, high=1_000_000),
    Threshold("repeat_word_ratio", high=0.3),
    Threshold("mean_word_length", low=2.0, high=15.0),
    Threshold("symbol_ratio", high=0.1),
    Threshold("exclamation_ratio", high=0.2),
    Threshold("stop_word_ratio", low=0.01),
    Threshold("dup_line_ratio", high=0.5),
    Threshold("ellipsis_line_ratio", high=0.3),
    Threshold("bullet_line_ratio", high=0.9),
)


def text_counts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the counts of every whole text.

    Windows are compared by 64-bit hashes of their words, and only inside one text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*keys, text.alias("_t"), words_of(F.col("text")).alias("_w"))
    split = base.select(
        *keys,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("_t") - F.length(F.replace(F.col("_t"), F.lit("!"), F.lit("")))).alias("_exclamations"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*STOP_WORDS))).alias("_stops"),
        F.filter(F.split("_t", "\n"), lambda line: line.rlike(NOT_BLANK)).alias("_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    last = F.size("_h") - WINDOW
    windows = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("_h", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lined = split.select(
        *keys, "n_words", "word_chars", "n_symbols", "_exclamations", "_stops",
        F.size("_lines").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda s: s.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$"))).alias("_ellipsis"),
        F.size(F.filter("_lines", lambda s: s.rlike(r"^[\x20\x09-\x0D]*[-*•]"))).alias("_bullets"),
        windows.alias("_win"),
    )
    # Most texts repeat no window: a hash set tells, and only the others are sorted.
    placed = lined.withColumn(
        "_sorted",
        F.when(
            F.size(F.array_distinct("_win")) < F.size("_win"),
            F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    ).drop("_win")

    def repeated(item: Column, j: Column) -> Column:
        before, after = F.get("_sorted", j - 1)["h"], F.get("_sorted", j + 1)["h"]
        return F.coalesce(before == item["h"], F.lit(False)) | F.coalesce(after == item["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("_sorted", repeated), lambda item: item["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, start: F.struct(
            (acc["n"] + F.least(F.lit(WINDOW), start - acc["last"])).cast("long").alias("n"), start.alias("last")
        ),
        lambda acc: acc["n"],
    )
    return placed.select(
        *keys, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.when(F.col("_sorted").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        "_exclamations", "_stops", "_n_lines", "_ellipsis", "_bullets",
    )


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


def apply_rules(docs: DataFrame, keys: list[str], thresholds: tuple[Threshold, ...] = THRESHOLDS) -> DataFrame:
    """Counts, ratios, the names of the failed rules, and ``kept`` (no rule failed)."""
    measured = text_counts(docs, keys).select(
        *keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        _share("n_repeat_words", "n_words").alias("repeat_word_ratio"),
        _share("word_chars", "n_words").alias("mean_word_length"),
        _share("n_symbols", "n_words").alias("symbol_ratio"),
        _share("_exclamations", "n_words").alias("exclamation_ratio"),
        _share("_stops", "n_words").alias("stop_word_ratio"),
        _share("n_dup_lines", "_n_lines").alias("dup_line_ratio"),
        _share("_ellipsis", "_n_lines").alias("ellipsis_line_ratio"),
        _share("_bullets", "_n_lines").alias("bullet_line_ratio"),
    )
    failed = F.array_compact(F.array(*[F.when(t.failed(), F.lit(t.metric)) for t in thresholds]))
    return measured.withColumn("failed_rules", failed).withColumn("kept", F.size("failed_rules") == 0)
