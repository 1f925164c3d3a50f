"""One query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    ann, bpe, langid, lines, mixing, negatives, packing, prefix_trie, quality_fm, rules, simhash, tools, urls,
)
from tidelog.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the url query.
URL_RULES = (
    urls.Rule(urls.ALLOW, "org/"),
    urls.Rule(urls.BLOCK, "example.org/es/"),
    urls.Rule(urls.BLOCK, "example.org/en/1"),
    urls.Rule(urls.ALLOW, "com/fr/"),
    urls.Rule(urls.BLOCK, "com/de/"),
)


# Tools of the tool-call query; their calls are derived from conversations.
TOOLS = (
    tools.Tool("search", (tools.Field("query", "string"), tools.Field("limit", "integer"))),
    tools.Tool("translate", (tools.Field("text", "string"), tools.Field("to", "string"))),
    tools.Tool("note", (tools.Field("text", "string"), tools.Field("urgent", "boolean", required=False))),
)


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of a hash of the id; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    machine = quality_fm.fit(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))
    return quality_fm.score(docs, machine).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_texts(read_table(spark, sf_dir, "documents"), ["doc_id"])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(
        docs, "source", lines_name="n_lines", dropped_name="n_dropped", found_name="n_boilerplate"
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.filter(~held_out).select("text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), model, "lang_pred", "score").select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def tool_events(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results derived from conversations.

    Every assistant turn is a call, whose tool, arguments and dependency follow from
    its text: some lack a field, have a wrong type or name no known tool, and texts of
    even length need the call before. The user turn that follows holds the result.
    """
    turns = conversations.select(
        "conv_id", "turn", "role", "text", F.length("text").alias("n"),
        F.concat(F.lit("c"), F.col("conv_id"), F.lit("-")).alias("prefix"),
    )
    n, text = F.col("n"), F.col("text")
    tool = F.when(n % 11 == 0, "unknown").otherwise(
        F.element_at(F.array(*[F.lit(t.name) for t in TOOLS]), (n % 3 + 1).cast("int"))
    )
    limit = F.when(n % 7 == 0, F.lit("many")).cast("string")
    arguments = (
        F.when(F.col("name") == "search", F.when(limit.isNotNull(), F.to_json(F.struct(text.alias("query"), limit.alias("limit"))))
               .otherwise(F.to_json(F.struct(text.alias("query"), n.alias("limit")))))
        .when(F.col("name") == "translate", F.to_json(F.struct(F.when(n % 5 != 0, F.lit("en")).alias("to"), text.alias("text"))))
        .when(F.col("name") == "note", F.to_json(F.struct((n % 2 == 0).alias("urgent"), text.alias("text"))))
        .otherwise(F.to_json(F.struct(n.alias("value"))))
    )
    calls = turns.filter("role = 'assistant'").withColumn("name", tool).select(
        "conv_id", "turn", F.concat("prefix", "turn").alias("call_id"), "name", arguments.alias("arguments"),
        F.when((n % 2 == 0) & (F.col("turn") > 2), F.array(F.concat("prefix", F.col("turn") - 2))).alias("needs"),
    )
    results = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.concat("prefix", F.col("turn") - 1).alias("call_id"), text.alias("content")
    )
    return calls, results


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_events(read_table(spark, sf_dir, "conversations"))
    return tools.link_calls(calls, results, TOOLS).select(
        "conv_id", "turn", "call_id", "name", "level", "linked",
        (F.size("errors") == 0).alias("valid"), F.array_join("errors", ",").alias("errors"), "message",
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.apply_rules(read_table(spark, sf_dir, "documents"), ["doc_id"])
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & F.col("kept")).alias("kept"),
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(read_table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.rebuild(turns, group=5, folds=9))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), shifted, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    "op1_quality_fm": op1_quality_fm,
    "op2_bpe": op2_bpe,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_tool_calls": op5_tool_calls,
    "op6_url_filter": op6_url_filter,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_nearest": op10_nearest,
    "op11_packing": op11_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
}
