"""A corpus pipeline: documents in, sampled token sequences of what is worth keeping out.

Each stage takes the rows that its predecessor kept, read again from Parquet in the shared folder, and all of their columns go
on. Rows that a stage has no reason to reject stay: a null or unknown id is no reason."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ddlscope.llm import factorisation, lattice, ledger, superminhash, templates
from ddlscope.llm.texts import text_key
from ddlscope.session import scratch_path

ACCEPT = 0.3
SAMPLES = 2


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores below `ACCEPT` go."""
    model = factorisation.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return factorisation.accepted(docs, model, ACCEPT)


def by_row(docs: DataFrame) -> DataFrame:
    """The documents as one column, whatever their columns are called, with what tells rows apart."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("of_id"), text_key().alias("of_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays, with the least id. Rows go by id and text, so that texts that share an id are
    told apart. Of rows with the same id and text one stays, that of the least hash over all columns, then of the least columns."""
    grouped = superminhash.grouped(docs, size=5, percent=80)
    gone = grouped.filter("NOT stays").select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_text")).distinct()
    order = [F.xxhash64(*(F.col("row").getField(c) for c in docs.columns)), F.col("row")]
    nth = F.row_number().over(Window.partitionBy("of_id", "of_text").orderBy(*order))
    return by_row(docs).join(gone, ["of_id", "of_text"], "left_anti").withColumn("nth", nth).filter("nth = 1").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a question of the benchmark, also with other numbers, names or units, go: by their text, whatever the id."""
    digest = F.sha2(F.col("text"), 256)
    texts = docs.select(digest.alias("doc_id"), "text")
    leaking = templates.leaks(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc_id").alias("of_text")).distinct()
    rows = docs.select(F.struct("*").alias("row"), digest.alias("of_text"))
    return rows.join(leaking, "of_text", "left_anti").select("row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; `n_chars`, where there is one, follows the text."""
    book = ledger.Ledger(spark, scratch_path(spark, "ledger"))
    book.commit(docs, ledger.REDACTED)
    found = book.report(docs, ledger.REDACTED)
    changed = {"text": ledger.redacted(F.col("row.text"), F.col("found"))}
    if "n_chars" in docs.columns:
        stated = F.col("row.n_chars")
        changed["n_chars"] = F.when(F.col("found").isNull(), stated).otherwise(F.length(changed["text"]).cast(docs.schema["n_chars"].dataType))
    return found.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def sampled_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of each text, as ids of pieces, that decode to it."""
    return lattice.encode(docs, samples=SAMPLES)


STAGES = [("quality classifier", quality_classifier), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontamination),
          ("secret scans", secret_scan), ("SentencePiece encoding and decoding", sampled_pieces)]
#: Fitted models, signatures and sampling are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
