"""From raw documents to packed sequences: toxic documents go, then near copies, then repeated
passages; what is left is packed.

Every stage takes (spark, documents, folder of tables) and returns documents, the last one packed
pieces. A stage's rows are written to the shared scratch folder and read again by the next.

Rows with a NULL `doc_id` stay in the corpus: they have no number to be compared by. Rows that
repeat a `doc_id` are compared like any others. Extra columns are carried along. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaweave.llm import packing, simhash, substrings, toxicity
from areaweave.llm.work import free_name, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the tagger learns from labels of the kept folds."""
    model = toxicity.learnt(docs, table(spark, sf_dir, "labels"))
    named = docs.withColumnsRenamed({c: f"doc__{c}" for c in docs.columns})
    scored = toxicity.score_toxicity(named, model, "doc__text")
    return scored.where("score < 0.5").select(*[
        F.col(f"`doc__{c}`").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest number, and of several with
    that number the one with the smallest hash of its text. Groups, not numbers, are what one
    row each is kept of: texts that repeat a number without being near stay both."""
    version, first = free_name(docs.columns, "version"), free_name(docs.columns, "first")
    named = docs.where("doc_id IS NOT NULL").withColumn(
        version, F.struct("doc_id", F.xxhash64("text").alias("mark")))
    groups = simhash.simhash_groups(
        named.unionByName(docs.where("doc_id IS NULL"), allowMissingColumns=True), version)
    least = groups.where(F.col(version) == F.col("component_id")).select(version).distinct()
    # Rows of one number and text can differ in what else they carry.
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kept = named.join(least, version, "left_semi").groupBy(version).agg(
        F.min_by(whole, others).alias(first)).select(f"`{first}`.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut; a document of which nothing is left goes. Texts without a
    repeat stay as they are, line breaks included."""
    named = docs.withColumnsRenamed({c: f"doc__{c}" for c in docs.columns})
    cut = substrings.substring_dedup(named, "doc__doc_id", "doc__text")
    changed = F.col("n_removed") > 0
    return cut.where(~changed | (F.col("kept_text") != "")).select(*[
        F.when(changed, F.col("kept_text")).otherwise(F.col("doc__text")).alias(c)
        if c == "text" else
        F.when(changed, F.length("kept_text")).otherwise(F.col("doc__n_chars"))
        .cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(f"`doc__{c}`").alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Workers of the stages before still stand beside those that encode, and these beside those
    # of the next run.
    return packing.pack_documents(docs, cached_units=250_000, forget=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("best_fit_packing", pack),
]

# Trained scores, 64-bit hashes and a tokenizer cannot be written as SQL; the tests compare the
# stages with plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
