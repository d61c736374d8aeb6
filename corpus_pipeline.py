"""Raw documents to token ids: every stage works on all that the one before kept.

Each stage is written as Parquet and read again, so a stage sees fixed rows whatever executors are lost.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm.byte_bpe import encode_texts
from ledgerline.llm.jaccard import similar_documents
from ledgerline.llm.language import UNKNOWN, held_out, identify, train
from ledgerline.llm.mixing import mixed
from ledgerline.llm.simhash import one_of_each
from ledgerline.llm.suffix_array import clean_repeated_bytes
from ledgerline.session import scratch_path

BYTE_RANKS = "byte_bpe_multi_50k.tiktoken"
LEAST_SCORE = 0.5
# Nats per n-gram by which a text may fall short of its language. Junk and most texts in other languages do by two and more;
# one clean text in 500 does by more than one, one in 8,000 by more than this.
LEAST_FIT = -1.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose language is unknown or unsure, or that are none of the learned languages; the others as they are."""
    model = train(docs.where(~held_out("doc_id")), "text", "lang")
    lang, score, fit = _free_names(docs, "lang_pred", "score", "fit")
    found = identify(docs, model, "text", lang, score, fit)
    known = (F.col(lang) != UNKNOWN) & (F.col(score) >= LEAST_SCORE) & (F.col(fit) >= LEAST_FIT)
    return found.where(known).select(docs.columns)


def _free_names(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name = f"_{name}"
        out.append(name)
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, Jaccard similarity 0.8 or more."""
    return one_of_each(docs, find=similar_documents)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without text that an earlier document has, and ``n_chars`` of what is left."""
    return clean_repeated_bytes(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; the toxic ones go."""
    return mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``, and whether decoding gives the text back."""
    path = public_tokenizers.path(BYTE_RANKS)
    coded = encode_texts(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded_column="decoded")
    same = F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("mixing", mix_domains),
    ("byte_bpe", to_token_ids),
]

# The classifiers, the search for near duplicates and the encoding are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
