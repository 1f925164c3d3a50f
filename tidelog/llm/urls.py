"""URL filter: rules first, then the ratio of two character language models.

The urls that a rule allows train one model, those that a rule blocks the other.
Each is a variable-order Markov model over the characters as they are: a character
is predicted from the longest context of up to ``ORDER`` characters that was seen
before, smoothed with all shorter ones down to a uniform share, each by the number of
different followers of the context (Witten-Bell). A url without a rule is allowed if
its length-normalised log-likelihood difference reaches a threshold; that is the
score with the best balanced accuracy on rule-labelled urls held out of training.

Every different url is cut into grams of ``ORDER + 1`` characters, and these are
counted; shorter ones are sums over the longer ones. The table of grams grows with the
urls and is never broadcast beyond ``BROADCAST_ROWS``: it is built order by order with
shuffle joins, and scores join it by gram, the frequent grams (fewer than ``HOT_GRAMS``,
whatever the data) apart. Only urls are shuffled, never pages.

Cases: a null url or one without ``://`` has an empty host and path and fits no
rule; a null or empty url is blocked; equal urls get equal results; urls of any length
are read whole; rules of the same length are ordered by host length, then by text;
without any labelled url the score is 0 and the threshold 0; an empty table gives no
rows; extra columns are ignored; null page ids pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import BROADCAST_ROWS, materialize

ALLOW, BLOCK = "allow", "block"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Characters of the longest context, and the mark in front of a url.
ORDER, START = 5, "\u0002"
# Grams with over this fraction of all places are joined by broadcast.
HOT_GRAMS = 4096

# Scores are binned for the calibration only: width and outermost bin.
BIN_WIDTH, LAST_BIN = 0.01, 1000
HELD_OUT_FOLDS = 5


@dataclass(frozen=True)
class Rule:
    """``host/path``: fits the host and its subdomains if the path has this prefix."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].translate(str.maketrans(UPPER, LOWER))

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return (
        F.translate(F.regexp_extract(known, pattern, 1), UPPER, LOWER),
        F.regexp_extract(known, pattern, 2),
    )


def with_parts(pages: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return pages.select("page_id", "url", host.alias("host"), path.alias("path"))


def with_grams(urls: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` and ``gram`` for each character of a url: it and the ``ORDER`` ones before it."""
    marks = F.array(*[F.lit(START)] * ORDER)
    characters = F.concat(marks, F.filter(F.split("url", ""), lambda c: c != ""))
    # A column of its own: inside the function below, a url would be split for every character.
    cut = urls.withColumn("_characters", characters)
    grams = F.transform(
        F.sequence(F.lit(ORDER), F.size("_characters") - 1),
        lambda i: F.concat(*[F.get("_characters", i - k) for k in reversed(range(ORDER + 1))]),
    )
    return cut.select(*columns, F.explode(grams).alias("gram"))


def with_rule(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Add ``rule`` and ``_label``: text and verdict of the longest rule that fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    host, path = F.col("host"), F.col("path")

    def first(value) -> Column:
        choices = [F.when(r.fits(host, path), F.lit(value(r))) for r in ordered]
        return F.coalesce(*choices, F.lit(None).cast("string"))

    return pages.withColumn("rule", first(lambda r: r.text)).withColumn("_label", first(lambda r: r.verdict))


def _held_out() -> Column:
    digits = F.substring(F.md5(F.coalesce(F.col("url"), F.lit(""))), 1, 7)
    return F.conv(digits, 16, 10).cast("int") % HELD_OUT_FOLDS == 0


def different_urls(judged: DataFrame) -> DataFrame:
    """``url, id, label, held_out, n``: every different url that has characters, and its pages."""
    urls = judged.filter("url <> ''").groupBy("url").agg(F.first("_label").alias("label"), F.count(F.lit(1)).alias("n"))
    return urls.select("url", F.unhex(F.md5("url")).alias("id"), "label", _held_out().alias("held_out"), "n")


def gram_counts(urls: DataFrame) -> DataFrame:
    """``gram, allow, block, places``: training weight under each label, and places in all urls."""
    def weight(label: str) -> Column:
        return F.when((F.col("label") == label) & ~F.col("held_out"), F.col("n")).otherwise(0)

    each = with_grams(urls, weight(ALLOW).alias(ALLOW), weight(BLOCK).alias(BLOCK))
    return each.groupBy("gram").agg(F.sum(ALLOW).alias(ALLOW), F.sum(BLOCK).alias(BLOCK), F.count(F.lit(1)).alias("places"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram, ratio, places`` for every gram of ``counts``: log P(allowed) - log P(blocked)."""
    orders = [counts]
    for k in reversed(range(ORDER)):
        # The last k + 1 characters: one less than the order above has.
        shorter = orders[0].groupBy(F.substring("gram", 2, k + 1).alias("gram"))
        orders.insert(0, materialize(shorter.agg(*[F.sum(c).alias(c) for c in (ALLOW, BLOCK, "places")]), f"url-grams-{k}"))
    sizes = orders[0].agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in (ALLOW, BLOCK)]
    ).first()
    model = orders[0].select(
        "gram", "places", *[((F.col(v) + 1) / F.lit(float(sizes[v] + sizes["n"]))).alias(f"p_{v}") for v in (ALLOW, BLOCK)]
    )
    for k in range(1, ORDER + 1):
        # Different followers of a context: no more than there are characters.
        context = Window.partitionBy(F.substring("gram", 1, k))
        seen = orders[k].select("*", *[c for v in (ALLOW, BLOCK) for c in (
            F.sum(v).over(context).alias(f"n_{v}"), F.sum(F.when(F.col(v) > 0, 1).otherwise(0)).over(context).alias(f"t_{v}"))])
        shorter = model.select(F.col("gram").alias("end"), *[F.col(f"p_{v}").alias(f"q_{v}") for v in (ALLOW, BLOCK)])
        joined = seen.join(shorter, F.substring("gram", 2, k) == F.col("end"))
        model = materialize(joined.select("gram", "places", *[
            _interpolate(F.col(v), f"n_{v}", f"t_{v}", F.col(f"q_{v}")).alias(f"p_{v}") for v in (ALLOW, BLOCK)
        ]), f"url-order-{k}")
    return model.select("gram", (F.log(f"p_{ALLOW}") - F.log(f"p_{BLOCK}")).alias("ratio"), "places")


def _interpolate(count: Column, total: str, kinds: str, shorter: Column) -> Column:
    """Witten-Bell: a context with ``kinds`` followers gives that much weight to the shorter one."""
    weight = F.col(total) + F.col(kinds)
    return F.when(weight > 0, (count + F.col(kinds) * shorter) / weight).otherwise(shorter)


def score_urls(urls: DataFrame, model: DataFrame) -> DataFrame:
    """``id, score`` of the urls: the mean ratio of their grams, all of which are in the model."""
    each = with_grams(urls, "id")
    facts = model.agg(F.count(F.lit(1)).alias("rows"), F.sum("places").alias("places")).first()
    ratios = model.select("gram", "ratio")
    if facts["rows"] <= BROADCAST_ROWS:
        found = each.join(F.broadcast(ratios), "gram")
    else:
        # So many places can only be of fewer than HOT_GRAMS grams.
        hot = F.col("places") * HOT_GRAMS > facts["places"]
        frequent = F.broadcast(model.filter(hot).select("gram", "ratio"))
        rest = each.join(frequent, "gram", "left_anti").join(model.filter(~hot).select("gram", "ratio"), "gram")
        found = each.join(frequent, "gram").unionByName(rest)
    return found.groupBy("id").agg((F.sum("ratio") / F.count("ratio")).alias("score"))


def best_threshold(scored: DataFrame) -> DataFrame:
    """One row: the score that separates the held-out urls best (balanced accuracy)."""
    number = F.floor(F.col("score") / BIN_WIDTH)
    bins = (
        scored.filter("held_out AND label IS NOT NULL")
        .select("label", "n", F.greatest(F.least(number, F.lit(LAST_BIN)), F.lit(-LAST_BIN)).alias("bin"))
        .groupBy("bin")
        .agg(*[F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(v) for v in (ALLOW, BLOCK)])
    )
    # The number of bins is fixed, so this window is small whatever the data.
    grid = scored.sparkSession.range(-LAST_BIN, LAST_BIN + 1).select(F.col("id").alias("bin"))
    filled = grid.join(bins, "bin", "left").fillna(0, [ALLOW, BLOCK])
    ordered = F.array_sort(F.collect_list(F.struct("bin", F.col(ALLOW).alias("a"), F.col(BLOCK).alias("b"))))
    sides = filled.agg(ordered.alias("bins"), F.sum(ALLOW).alias("n_allow"), F.sum(BLOCK).alias("n_block"))
    # Walk up the bins: what lies below the cut is blocked. Equally good cuts meet in the middle.
    walk = F.aggregate(
        "bins",
        F.struct(
            F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"),
            F.lit(-1.0).alias("best"), F.lit(0).cast("long").alias("cut"), F.lit(0).cast("long").alias("until"),
        ),
        lambda s, x: F.struct(
            (s["a"] + x["a"]).alias("a"),
            (s["b"] + x["b"]).alias("b"),
            F.greatest(s["best"], _gain(s)).alias("best"),
            F.when(_gain(s) > s["best"], x["bin"]).otherwise(s["cut"]).alias("cut"),
            F.when(_gain(s) >= s["best"], x["bin"]).otherwise(s["until"]).alias("until"),
        ),
        lambda s: (s["cut"] + s["until"]) / 2 * BIN_WIDTH,
    )
    known = (F.col("n_allow") > 0) & (F.col("n_block") > 0)
    return sides.select(F.when(known, walk).otherwise(0.0).alias("threshold"))


def _gain(s: Column) -> Column:
    """Balanced accuracy (times two) when what was walked over is blocked."""
    return 1.0 - s["a"] / F.greatest(F.col("n_allow"), F.lit(1)) + s["b"] / F.greatest(F.col("n_block"), F.lit(1))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every page."""
    judged = with_rule(with_parts(pages.select("page_id", "url")), rules)
    urls = materialize(different_urls(judged), "urls")
    model = materialize(log_ratios(materialize(gram_counts(urls), "url-grams")), "url-ratios")
    scored = materialize(urls.join(score_urls(urls, model), "id"), "url-scores")
    threshold = materialize(best_threshold(scored), "url-threshold")
    judged = judged.join(scored.select(F.col("url").alias("_url"), "score"), F.col("url") == F.col("_url"), "left")
    passes = F.col("score") >= threshold.scalar()
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("_label", F.when(passes, ALLOW).otherwise(BLOCK)).alias("verdict"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
