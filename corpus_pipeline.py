"""From raw documents to token ids: language, near-duplicates, mixture, byte pairs.

Every stage takes what the one before kept, written as Parquet and read again; all but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headway.llm.bpe import encode_documents
from headway.llm.common import materialize, table
from headway.llm.language import in_known_language
from headway.llm.mixing import mixture
from headway.llm.near_dup import without_near_duplicates

#: Texts whose best language has a lower score are in none of the learnt ones.
LEAST_SCORE = 0.4
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the labelled ones have, go."""
    return in_known_language(docs, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8 or more) the document with the smallest doc_id stays."""
    return without_near_duplicates(docs, words=5, percent=80)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two thirds of the tokens, by the tempered shares of source, language and topic as far as these have so many."""
    return mixture(docs)


def byte_pairs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_chars, n_tokens, token_ids, and the digest of what these decode to."""
    kept = ("doc_id", "lang", "source", "n_chars")
    return encode_documents(docs, TOKENIZER, keep=kept, outputs=("n_tokens", "token_ids", "decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("source_mixture", source_mixture),
    ("byte_pairs", byte_pairs),
]

#: Language and byte pairs are no matter of SQL; a brute-force version tests the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
