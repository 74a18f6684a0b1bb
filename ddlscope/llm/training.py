"""A bounded sample of labelled rows for the models that are fitted here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

#: Rows divided by this in the crc32 of their id are held out.
FOLDS = 5


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """Labelled documents that are not held out, at most `per_class` of each label: the first in the order of a hash of the
    id, so the sample is bounded, and the same for the same rows. Contradicting labels of one id count as the greater one; of
    several rows with one id that with the least hash of its text is taken."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label")))
    order = F.xxhash64("doc_id")
    chosen = None
    for value in (0, 1):
        some = known.filter(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    # Bounded by twice `per_class` rows of two numbers. A task hands on one row of an id, however many it has.
    rows = documents.join(F.broadcast(chosen), "doc_id").withColumn("_nth", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))))
    return rows.filter("_nth = 1").drop("_nth")
