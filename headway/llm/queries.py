"""One registered query per operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.bpe import encode_documents
from headway.llm.common import table
from headway.llm.filter_audit import audit
from headway.llm.graph_search import nearest
from headway.llm.html_text import extract
from headway.llm.kd_search import exact_top_k
from headway.llm.language import identify_languages
from headway.llm.licenses import scan
from headway.llm.mixing import mixed
from headway.llm.near_dup import near_duplicates
from headway.llm.token_counts import token_counts
from headway.llm.token_files import token_files
from headway.llm.url_lists import host_of, judged
from headway.llm.vector_codes import compressed

#: The public vocabularies that the token queries use.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # as its SQL has it: the rarest cell decides the size
    return mixed(table(spark, sf_dir, "documents"), share=None)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return encode_documents(docs, TOKENIZER, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_nearest_by_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


#: Days that captures are spread over, from the first.
FIRST_DAY, DAYS = "2024-01-01", 730


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages as captures: the table has no day of fetching, so ids are dealt over the days."""
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(DAYS)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def list_entries_of(pages: DataFrame) -> DataFrame:
    """Dated list entries for a part of the hosts that occur, and of the domains above them, as their hashes say."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    names = hosts.select(F.explode(F.array("host", F.regexp_replace("host", r"^[^.]+\.", ""))).alias("name")).distinct()
    part = lambda at: F.conv(F.substring(F.md5("name"), at, 6), 16, 10).cast("int")
    on = F.date_add(F.lit(FIRST_DAY).cast("date"), part(1) % DAYS)
    off = F.date_add(on, 1 + part(7) % 200)
    again = F.date_add(off, 1 + part(13) % 100)
    leaves, returns = part(7) % 3 > 0, (part(7) % 3 > 0) & (part(13) % 2 == 0)
    steps = F.array(
        *[
            F.struct(day.alias("day"), F.lit(action).alias("action"), there.alias("there"))
            for day, action, there in ((on, "add", F.lit(True)), (off, "remove", leaves), (again, "add", returns))
        ]
    )
    lists = F.element_at(F.array(*map(F.lit, ("adult", "malware", "spam", "trusted"))), 1 + part(19) % 4)
    given = names.where(part(25) % 3 == 0).select("name", lists.alias("list"), F.inline(steps)).where("there")
    kind = F.when(F.col("list") == "trusted", F.lit("allow")).otherwise(F.lit("block"))
    return given.select("name", "list", kind.alias("kind"), "day", "action")


def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = judged(captures_of(pages), list_entries_of(pages))
    return found.withColumn("fetched_on", F.col("fetched_on").cast("string"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), TOKENIZER, end_id=2)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), k=10, every=100)


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("detections")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), BYTE_TOKENIZER, limit=512)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))[0]


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = (
    op1_mixed_sources,
    op2_main_text,
    op3_language_id,
    op4_bpe_round_trip,
    op5_nearest_by_graph,
    op6_url_lists,
    op7_token_files,
    op8_exact_top_k,
    op9_license_rules,
    op10_minhash_near_dedup,
    op11_token_counts,
    op12_vector_codes,
    op13_filter_interactions,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{fn.__name__: fn for fn in QUERIES}, "pipeline": corpus_pipeline.run}
