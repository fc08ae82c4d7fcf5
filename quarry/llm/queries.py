"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.ann import nearest
from quarry.llm.bitsliced import oracle_sql as top_k_sql
from quarry.llm.bitsliced import top_k
from quarry.llm.chat_format import format_chats
from quarry.llm.collocations import collocations
from quarry.llm.collocations import oracle_sql as collocations_sql
from quarry.llm.common import table
from quarry.llm.html_extract import extract
from quarry.llm.langid import held_out, predict, train
from quarry.llm.line_dedup import dedup
from quarry.llm.mixing import mix
from quarry.llm.mixing import oracle_sql as mixing_sql
from quarry.llm.packing import pack
from quarry.llm.quality import quality_rules
from quarry.llm.runs import find_runs
from quarry.llm.simhash import near_duplicates
from quarry.llm.token_counts import token_counts


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages"))


# How the stand-in transcripts mark their speakers, by conversation.
STYLES = [("System:", "User:", "Assistant:"), ("SYSTEM:", "Human:", "AI:"), ("### Instruction:", "### Question:", "### Answer:"),
          ("**System**:", "**Q**:", "**A**:"), ("<|system|>", "<|user|>", "<|assistant|>")]


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in input: ``conv_id, transcript``, the turns of ``conversations`` each behind a speaker marker."""
    style = F.element_at(F.array(*(F.array(*map(F.lit, s)) for s in STYLES)), (F.pmod("conv_id", F.lit(len(STYLES))) + 1).cast("int"))
    marker = F.element_at(style, F.when(F.col("role") == "system", 1).when(F.col("role") == "user", 2).otherwise(3))
    turns = table(spark, sf_dir, "conversations").select(
        "conv_id", F.struct("turn", F.concat_ws(" ", marker, "text").alias("text")).alias("turn"))
    return turns.groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["text"]),
                                                     "\n").alias("transcript"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles and canonical turns of all conversations, from their transcripts."""
    return format_chats(transcripts(spark, sf_dir)).select("conv_id", "n_turns", F.transform("turns", lambda t: t["role"]).alias("roles"), "rendered")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdicts of all documents."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of all documents."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat, or nearly repeat, an earlier one."""
    return dedup(table(spark, sf_dir, "documents", "doc_id", "text")).select("row.doc_id", "n_lines", "n_removed", "row.text")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))
    return predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "spans")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 ids."""
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of all documents: 3-word shingles, at most 3 differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every embedding whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 rows of largest integer inner product for every embedding whose id is divisible by 100."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, 10)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, those of some ids made periodic."""
    return find_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extract": op1_html_extract,
    "op2_chat_format": op2_chat_format,
    "op3_quality_rules": op3_quality_rules,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_packing": op7_packing,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL: dict[str, str] = {"op4_mixing": mixing_sql(), "op11_exact_top_k": top_k_sql(), "op12_collocations": collocations_sql()}
