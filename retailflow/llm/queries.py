"""The operators as registered queries over the given tables, with the
production parameters. Each derives the contract's columns from its
operator's output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailflow.llm import pii
from retailflow.llm.align import alignments
from retailflow.llm.caps import near_vectors
from retailflow.llm.common import table
from retailflow.llm.exact import exact_duplicates
from retailflow.llm.knn import top_k
from retailflow.llm.lexical import search
from retailflow.llm.minhash import near_duplicates
from retailflow.llm.mixing import mix
from retailflow.llm.oracles import ORACLES
from retailflow.llm.packing import pack_documents
from retailflow.llm.substrings import repeated_passages
from retailflow.llm.tokens import count_tokens
from retailflow.llm.toxicity import is_training, score, train
from retailflow.llm.urls import judge

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "window", "step_group",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = repeated_passages(table(spark, sf_dir, "documents"))
    return passages.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = score(docs, train(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select(
        "row.doc_id",
        F.coalesce(~is_training(F.col("row.doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


#: Target shares: the source that has most is held at a quarter, three are raised.
MIX_WEIGHTS = {"src0": 0.25, "src1": 0.1, "src2": 0.1, "src3": 0.05}
MIX_SEED = 17


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix(docs, MIX_WEIGHTS, MIX_SEED).select("row.*", "copy")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("row.page_id", "host", "path", "rule", "verdict", F.col("blocked").alias("block_chance"))


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.train(docs))
    every = F.array_sort(F.concat("base", "added"))

    def counted(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long")

    return found.select(
        "row.doc_id",
        *(counted(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)),
        F.sha2(pii.printed(F.col("base")), 256).alias("base_sha256"),
        pii.printed(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = map(public_tokenizers.path, (BYTE_BPE, PIECE_BPE))
    return alignments(table(spark, sf_dir, "documents"), *paths).drop("links")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_token_counts, op2_packing, op3_substring_dedup, op4_top_k, op5_toxicity, op6_source_mix, op7_url_filter,
        op8_minhash_dedup, op9_embedding_dedup, op10_pii, op11_exact_dedup, op12_token_alignment, op13_lexical_search,
    )
    return {f.__name__: f for f in every}


def llm_oracle() -> dict[str, str]:
    return dict(ORACLES)
