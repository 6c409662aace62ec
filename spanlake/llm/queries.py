"""The text operators as queries on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import bpe, chat
from spanlake.llm import decontamination as dc
from spanlake.llm import near_duplicates as nd
from spanlake.llm import quality_rules as qr
from spanlake.llm import token_files as tf
from spanlake.llm import toxicity as tox
from spanlake.llm import url_rules, warc
from spanlake.llm.common import load
from spanlake.llm import token_alignment as ta
from spanlake.llm import turn_repair as tr
from spanlake.llm import vector_duplicates as vd
from spanlake.llm.token_counts import token_counts
from spanlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        return f

    return register


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that the rules rest on, and the verdict of the base and of the cascade."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    verdict = qr.cascade(docs)
    counted = docs.select(
        "doc_id",
        qr.let(
            qr.words(F.col("text")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                qr.repeated_positions(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        qr.word_chars(F.col("text")).alias("word_chars"),
        qr.symbols(F.col("text")).alias("n_symbols"),
        qr.repeated_lines(F.col("text")).alias("n_dup_lines"),
        verdict.isNull().alias("passed"),
    )
    failed = (F.col("w.n_words") < qr.MIN_WORDS) | (
        100 * F.col("w.n_repeat_words") > 30 * F.col("w.n_words")
    )
    return counted.select(
        "doc_id",
        "w.n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "w.n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("passed")).alias("kept"),
    )


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a grammar fitted on the labels that are not held out."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = tox.fit(docs, load(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return tox.scores(docs, model).select(
        "doc_id",
        tox.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > 4096).alias("over_limit"),
    )


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from the token files that all of them were written to."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    folder = tf.new_folder(spark)
    manifest = tf.write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return tf.read_token_files(manifest, folder).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes that they decode to."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.decode(bpe.encode(docs, ranks), ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# Host, path and verdict of the rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query("op3_url_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(pages, rules).drop("url")


@query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages as read back from the archives they were written to."""
    pages = load(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = scratch_path(spark, "warc")
    archives = warc.write_archives(pages, folder)
    return (
        warc.read_archives(archives, folder)
        .where("CASE WHEN gap IS NULL THEN true ELSE raise_error(concat('gap in ', file, ': ', gap)) END")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )


@query("op7_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at a Jaccard similarity of 0.8."""
    return nd.join_counts(load(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document contains, also with other names and numbers."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return dc.report(docs, load(spark, sf_dir, "benchmark").select("item_id", "text"))


@query("op6_chat")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversations(load(spark, sf_dir, "conversations"))


@query("op11_token_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenisations of every document, and how frequent the linked ids are."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    parts = ta.align(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    hashed = parts._replace(rows=parts.rows.withColumn("groups_sha256", digest).drop("groups"))
    return ta.with_pair_counts(hashed).select(
        "doc_id", *ta.COUNTS, "n_best", "count_sum", "groups_sha256"
    )


@query("op12_vector_duplicates")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and survivor of every vector at a cosine of 0.93 within its label."""
    found = vd.near_vectors(load(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


@query("op13_turn_repair")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and the cheapest edits that repair it."""
    found = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return tr.summaries(tr.repair(tr.damaged(found), ids=found))
