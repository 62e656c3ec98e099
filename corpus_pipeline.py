"""From documents to packed training sequences.

Five stages, each one operator: documents judged toxic go, one document of
each group of near-duplicates stays, personal data is replaced by its kind,
sources are brought to their target shares, and what is left is packed into
context windows. Each stage's result is written as Parquet and read again as
the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import pii, toxicity
from retailflow.llm.common import table, written
from retailflow.llm.minhash import near_duplicates
from retailflow.llm.mixing import mix
from retailflow.llm.packing import pack_documents
from retailflow.llm.queries import MIX_SEED, MIX_WEIGHTS, WORD_BPE

TOXIC = 0.5
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose probability of being toxic is below TOXIC. Models
    and curve are learnt from these documents and their labels."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where(F.col("score") < TOXIC).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (linked from a similarity
    of NEAR_PERCENT on), that of the smallest id. Rows are compared each for
    itself, so of rows that repeat an id and a text one stays, and rows
    without an id take part, behind all others."""
    rows = written(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("_number")), "numbered")
    texts = rows.select(F.col("_number").alias("doc_id"), "row.text")
    found = written(near_duplicates(texts, percent=NEAR_PERCENT).select("doc_id", "component_id"), "near")
    ids = rows.select(F.col("_number").alias("doc_id"), F.col("row.doc_id").alias("_id"))
    order = F.struct(F.col("_id").isNull(), "_id", "doc_id")
    grouped = found.groupBy("component_id").count().where("count > 1").select("component_id")
    members = found.join(grouped, "component_id").join(ids, "doc_id")
    first = written(members.groupBy("component_id").agg(F.min(order).alias("_first")), "near-first")
    gone = members.join(first, "component_id").where(F.col("doc_id") != F.col("_first.doc_id")).select(F.col("doc_id").alias("_number"))
    return rows.join(gone, "_number", "left_anti").select("row.*")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind in brackets;
    ``n_chars`` counts the new text. Null texts stay null."""
    found = pii.find(docs, pii.train(docs))
    found = found.select("row", F.col("row.text").alias("_old"), F.array_sort(F.concat("base", "added")).alias("_spans"))
    found = pii.redacted(found, "_old", "_spans", "_new")
    kept = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("_new")}
    if "n_chars" in docs.columns:
        length = F.length("_new").cast(docs.schema["n_chars"].dataType)
        kept["n_chars"] = F.when(F.size("_spans") > 0, length).otherwise(F.col("row.n_chars"))
    return found.select(*(c.alias(name) for name, c in kept.items()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated or thinned to the sources' target shares, in a
    globally shuffled order."""
    return mix(docs, MIX_WEIGHTS, MIX_SEED).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, with their ids."""
    return pack_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL has neither the trained models nor the tokenizer; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
