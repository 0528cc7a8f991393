"""From raw documents to packed sequences: five operators in a row, each on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineledger.llm.chunk_dedup import dedup_substrings
from lineledger.llm.decontaminate import contamination
from lineledger.llm.language_id import UNDETERMINED, held_out, identify, train
from lineledger.llm.packing import pack
from lineledger.llm.queries import table, tokenizer_file
from lineledger.llm.shared import Staged
from lineledger.llm.simhash import survivors

LEAST_SCORE = 0.5  # of the language that a document is kept for
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is less likely than all others together.

    Learns from the documents with a language that the operator's query learns from, too.
    """
    model = train(docs.where(~held_out()))
    found = identify(docs, model, *(F.col(c) for c in COLUMNS))
    # without any language to learn from there is nothing to reject by but the lack of letters
    sure = F.lit(not model.languages) | (F.col("score") >= LEAST_SCORE)
    known = F.col("lang_pred") != UNDETERMINED if model.languages else F.col("text").rlike(r"\p{L}")
    return found.where(known & sure).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of documents with near fingerprints the one with the smallest id.

    Groups, not ids, decide: every group keeps one row, also where documents share an id or have none. Documents
    without an id are kept only in a group that has no id at all.
    """
    return survivors(docs.select(*COLUMNS), "doc_id", "text", shingle=3, radius=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what repeats from documents with smaller ids out of the texts; documents that are nothing else go."""
    found = dedup_substrings(docs, *(F.col(c) for c in COLUMNS))
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    found = found.where((F.col("n_removed") == 0) | F.col("kept").rlike(r"\S")).withColumn("text", text)
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are contaminated by the benchmark, and no others that share their id or have none."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"), mark_col="bad_mark")
    bad = found.where("contaminated").select(F.col("doc_id").alias("bad_id"), "bad_mark").distinct()
    same = docs["doc_id"].eqNullSafe(F.col("bad_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("bad_mark"))
    return docs.join(bad, same, "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its ids and its place in a sequence of at most 1024 ids."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"), end_id=2, size=1024, keep_ids=True)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: The first stage is a trained model, the third a rolling hash and the last a fit, none of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each one's result is stored and read back as the next one's input."""
    staged = Staged(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
