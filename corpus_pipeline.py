"""Corpus pipeline: documents through five stages, each written as Parquet and read again.

Toxicity, quality, near copies, benchmark decontamination, packing. A stage works on all that
the stage before it kept; all but the last return the columns of ``documents``.

Nulls, empty texts, repeated rows and other columns are handled as the operators say. Rows with
null doc_id are kept or dropped like others, by id and text together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratlab.llm.common import Scratch
from stratlab.llm.decontam import find_leaks
from stratlab.llm.neardup import near_duplicates, text_key
from stratlab.llm.packing import pack_documents
from stratlab.llm.quality import classify_quality
from stratlab.llm.queries import tokenizer_path, trusted_ids
from stratlab.llm.toxicity import score_toxicity
from stratlab.plans.inputs import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under 0.5."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=COLUMNS)
    return scored.where(F.col("score") < 0.5).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of trusted text does not find odd for their language."""
    scored = classify_quality(docs, trusted_ids(table(spark, sf_dir, "labels")), carry=COLUMNS, across_words=True)
    return scored.where("kept").select(*COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest id; of rows equal in id and text, one."""
    row = F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.hex("text_key")))
    best = near_duplicates(docs).where("text_rank = 1").select(row.alias("_row")).distinct()
    keyed = docs.select(*COLUMNS, F.hex(text_key()).alias("_key"))
    keyed = keyed.withColumn("_row", F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "_key")))
    one = F.row_number().over(Window.partitionBy("_row").orderBy("lang", "source", "n_chars"))
    return keyed.join(best, "_row").withColumn("_n", one).where("_n = 1").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    found = find_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.where(F.size("leaks") == 0).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack_documents(docs, tokenizer_path(), 2048).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: No stage can be written as SQL: they run trained models, hashing and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents below ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
