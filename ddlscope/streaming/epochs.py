"""What the triggers of a stream have written, merged when it is read, and compacted every so often.

Each trigger writes a folder of its own, `epoch=N`, which a repeated trigger overwrites; only a folder whose write has been
committed counts. Every `every` epochs all that is there is merged into one table, `_compacted/through=N`, so a reader takes the
last of these and the few epochs after it, however long the stream has run. A trigger that is repeated after its epoch was
compacted changes nothing: its folder is not looked at. Epochs and tables that a compaction replaces stay until the next one,
for readers that have begun."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ddlscope import folders

EVERY = 16


class Epochs:
    """`merge` turns rows of several epochs, told apart by `epoch`, into one state. Merged rows may be merged again, with the
    number of the last epoch in them."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], every: int = EVERY):
        self.spark, self.path, self.merge, self.every = spark, path.rstrip("/"), merge, every

    def _compacted(self) -> str:
        return f"{self.path}/_compacted"

    def write(self, rows: DataFrame, epoch: int) -> None:
        """Write the rows of a trigger, and compact when it is time."""
        rows.write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")
        if (epoch + 1) % self.every == 0:
            self.compact(epoch)

    def compact(self, through: int) -> None:
        """Merge all epochs up to this one into one table."""
        before = folders.finished(self.spark, self._compacted(), "through")
        if before and before[-1] >= through:
            return
        self.read(through).write.mode("overwrite").parquet(f"{self._compacted()}/through={through}")
        if before:
            folders.remove(self.spark, self._compacted(), "through", before[-1])
            folders.remove(self.spark, self.path, "epoch", before[-1] + 1)

    def parts(self, through: int | None = None) -> tuple[int | None, list[int]]:
        """The compacted table that is read, and the epochs after it."""
        tables = [n for n in folders.finished(self.spark, self._compacted(), "through") if through is None or n <= through]
        last = tables[-1] if tables else None
        epochs = folders.finished(self.spark, self.path, "epoch")
        return last, [n for n in epochs if (last is None or n > last) and (through is None or n <= through)]

    def read(self, through: int | None = None) -> DataFrame:
        """The state as of the last epoch, or of the one given."""
        table, epochs = self.parts(through)
        found = []
        if table is not None:
            found.append(self.spark.read.parquet(f"{self._compacted()}/through={table}").withColumn("epoch", F.lit(table).cast("bigint")))
        if epochs:
            later = self.spark.read.option("basePath", self.path).parquet(*(f"{self.path}/epoch={n}" for n in epochs))
            found.append(later.withColumn("epoch", F.col("epoch").cast("bigint")))
        if not found:
            raise FileNotFoundError(f"no trigger has written to {self.path}")
        rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        return self.merge(rows)
