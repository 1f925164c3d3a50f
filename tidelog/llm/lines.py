"""Line dedup by site-relative frequency.

A line is boilerplate of a host if it stands on more than ``ratio`` of the host's
pages (and on ``min_pages`` at least): pages with the line, divided by all pages of
the host. Its boilerplate lines are dropped from every page of the host.

Hot hosts and hot lines are only counted, with partial sums. A host has at most
its lines per page divided by ``ratio`` boilerplate lines, whatever its size; these
sets are joined with the pages, by broadcast if there are few of them in all.

Cases: a null host is one more host; a null text stays null and counts as a page;
lines without a word are never dropped; a line that a page repeats counts once per
page and is dropped everywhere on it; a page that would lose all its lines with a
word is left as it is (whole copies are a matter for document dedup), which shows in
the number of lines found, if it is asked for; repeated rows
are pages of their own; an empty table gives no rows; all columns are kept. Lines
are compared by a 128-bit hash of the whole line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import BROADCAST_ROWS, NOT_BLANK, free_name, materialize

# A few pages in a hundred; and a line of one or two pages says nothing about a site.
RATIO = 0.02
MIN_PAGES = 3


def _has_word(line: Column) -> Column:
    return line.rlike(NOT_BLANK)


def _hash(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, line_hash, pages, total`` of the boilerplate lines of every host."""
    sites = pages.select(F.col(host).alias("host"), "text")
    totals = sites.groupBy("host").agg(F.count(F.lit(1)).alias("total")).withColumnRenamed("host", "_host")
    lines = sites.select(
        "host", F.explode(F.array_distinct(F.filter(F.split("text", "\n"), _has_word))).alias("line")
    )
    counts = (
        lines.groupBy("host", _hash(F.col("line")).alias("line_hash"))
        .agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= min_pages)
    )
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("_host")))
        .filter(F.col("pages") > F.col("total") * F.lit(float(ratio)))
        .select("host", "line_hash", "pages", "total")
    )


def drop_boilerplate(pages: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     lines_name: str | None = None, dropped_name: str | None = None,
                     found_name: str | None = None) -> DataFrame:
    """The pages without boilerplate lines in ``text``; optionally with three more
    columns, the number of lines with a word, how many of them were dropped, and how
    many are boilerplate (more than were dropped on a page of boilerplate alone)."""
    found = materialize(boilerplate(pages, host, ratio, min_pages), "boilerplate")
    key, bad, split, kept = (free_name(pages, c) for c in ("_site", "_bad", "_lines", "_kept"))
    sets = found.groupBy("host").agg(F.collect_set("line_hash").alias(bad)).withColumnRenamed("host", key)
    if found.count() <= BROADCAST_ROWS:
        sets = F.broadcast(sets)
    joined = pages.join(sets, F.col(host).eqNullSafe(F.col(key)), "left")
    parts = joined.withColumn(split, F.split("text", "\n"))
    parts = parts.withColumn(
        kept,
        F.when(
            F.col(bad).isNotNull(),
            F.filter(split, lambda s: ~_has_word(s) | ~F.array_contains(F.col(bad), _hash(s))),
        ).otherwise(F.col(split)),
    )
    n_before = F.size(F.filter(split, _has_word))
    n_after = F.size(F.filter(kept, _has_word))
    changed = (F.size(kept) < F.size(split)) & (n_after > 0)
    extra = []
    if lines_name:
        extra.append(F.coalesce(F.when(F.col("text").isNotNull(), n_before), F.lit(0)).cast("long").alias(lines_name))
    if dropped_name:
        extra.append(F.coalesce(F.when(changed, n_before - n_after), F.lit(0)).cast("long").alias(dropped_name))
    if found_name:
        found_lines = F.when(F.col("text").isNotNull(), n_before - n_after)
        extra.append(F.coalesce(found_lines, F.lit(0)).cast("long").alias(found_name))
    text = F.when(changed, F.array_join(kept, "\n")).otherwise(F.col("text")).alias("text")
    return parts.select(*[text if c == "text" else F.col(c) for c in pages.columns], *extra)
