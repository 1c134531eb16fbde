"""Registered queries of the dealt operators: thin uses with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratlab.plans.inputs import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as of good quality, and never as bad."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the trusted ones, and the verdict."""
    from stratlab.llm.quality import classify_quality

    return classify_quality(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")), across_words=True)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents: one row per pair."""
    from stratlab.llm.decontam import find_leaks

    found = find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    from stratlab.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the rows that are not held out."""
    from stratlab.llm.toxicity import score_toxicity

    scored = score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from stratlab.llm.html_blocks import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts (prefix dynamic programming) and the cut point at 512 tokens."""
    from stratlab.llm.tokens import count_prefix_tokens

    limit = 512
    counted = count_prefix_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), (limit,))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
                          F.col("fits")[0].alias("chars_within_limit"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 2048 tokens."""
    from stratlab.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 2048).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, read back and assembled into captures."""
    from stratlab.llm.common import Scratch
    from stratlab.llm.warc import assemble, read_records, write_archives

    scratch = Scratch(spark, "warc")
    path = scratch.path("archives")
    write_archives(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    captures = scratch.write(assemble(scratch.write(read_records(spark, path, with_payload=False), "records")).select(
        "capture_id", "response", F.nullif(F.col("metadata")[0]["fields"]["page-id"], F.lit("")).cast("bigint").alias("page_id")), "captures")
    payloads = captures.where("response.type = 'response'").select(
        F.col("capture_id").alias("first_id"), F.col("page_id").alias("first_page"),
        F.col("response.payload_bytes").alias("first_bytes"), F.col("response.payload_digest").alias("first_digest"))
    return captures.join(payloads, F.col("response.refers_to") == F.col("first_id"), "left").select(
        "page_id", F.coalesce("response.payload_bytes", "first_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "first_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), F.col("first_page").alias("refers_to"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and compression bands of all documents."""
    from stratlab.llm.rules import compression_rules

    return compression_rules(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 formatted, then read back."""
    from stratlab.llm.chat import as_chain, digest_formatted, format_conversations

    said = "</s>[INST] ok [/INST]"
    extra = spark.sql("select -7L conv_id, 0L turn, 'user' role, s text from values ('{0}') t(s) "
                      "union all select -7L, 1L, 'assistant', s from values ('{0}') t(s)".format(said))
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), "role", "text")
    return digest_formatted(format_conversations(as_chain(rows.unionByName(extra)), branches=1))


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all embeddings found for every twentieth, from a permutation index."""
    from stratlab.llm.permutation_index import search_neighbours

    return search_neighbours(table(spark, sf_dir, "embeddings"), k=20, query_step=20)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words in every document; the tails of a tenth of the documents are made periodic."""
    from stratlab.llm.runs import repeat_tail, run_digests

    return run_digests(table(spark, sf_dir, "documents"), repeat_tail).drop("n_words")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    from stratlab.llm.align import align_statistics

    return align_statistics(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_toxicity": op4_toxicity,
    "op5_main_text": op5_main_text,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_warc": op8_warc,
    "op9_rules": op9_rules,
    "op10_chat": op10_chat,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE: dict[str, str] = {}
