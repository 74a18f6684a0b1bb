"""The registered queries of the operators, over whole tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ddlscope.llm import (
    factorisation, fertility, hardneg, lattice, ledger, linededup, ring, severity, sql, substring, superminhash, templates, warc, whitening)
from ddlscope.llm.training import held_out
from ddlscope.session import scratch_path

SHARDS = 24
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL = sql.SQL


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    book = ledger.Ledger(spark, scratch_path(spark, "ledger"))
    # A history: each path began as its first line and was scanned by the rules of then. The second commit scans what is new:
    # the grown texts by all rules, and the texts it knows, grown or not, by the rules that have been added or changed.
    begun = documents.withColumn("text", F.substring_index("text", "\n", 1))
    book.commit(begun, (*ledger.BASE, ledger.HEADER))
    book.commit(begun.unionByName(documents), ledger.RULES)
    found, base = F.col("found"), [r.kind for r in ledger.BASE]
    return book.report(documents, ledger.RULES).select(
        "row.doc_id", *(ledger.count(found, kind).alias(f"n_{kind}") for kind in base),
        F.sha2(ledger.spans(ledger.of_kinds(found, base)), 256).alias("base_sha256"), ledger.spans(found).alias("spans"))


@query
def op2_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return templates.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.archive_rows(table(spark, folder, "pages"), least=1000), path)
    # Revisits are told from their headers; only responses have a payload to decode, which the digest then is taken of.
    records = warc.read(spark, path).filter(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.+)>$", 1).cast("long")
    is_response = F.col("record_type") == "response"
    return records.select(
        page("record_id").alias("page_id"), F.when(is_response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(is_response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type",
        page("refers_to").alias("refers_to"))


@query
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substring.without_repeats(table(spark, folder, "documents"), size=13)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op5_fertility_rules(spark: SparkSession, folder: str) -> DataFrame:
    return fertility.judge(table(spark, folder, "documents"))


@query
def op6_severity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return severity.grade(documents, severity.train(documents, table(spark, folder, "labels")))


@query
def op7_shard_ring(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = ring.place(rows, F.col("doc_id"), ["doc_id", "text_crc32", "size"], F.col("text_crc32"), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op8_lattice_samples(spark: SparkSession, folder: str) -> DataFrame:
    found = lattice.encode(table(spark, folder, "documents"), samples=3)
    return found.select("doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed",
                        "inclusion", "exact")


@query
def op9_factorisation_machine(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    scored = factorisation.score(documents, factorisation.train(documents, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op10_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, folder, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


@query
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(table(spark, folder, "embeddings"))
    return whitened.select("vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained", "identity_error")


@query
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = linededup.without_repeated_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
