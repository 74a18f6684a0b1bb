"""A store of generated `CREATE` texts that grows by generations.

The texts stand in one table that is bucketed by the object's keys, so that what is joined to it is moved to the texts and not
the other way around: finding what is still to be generated, adding a generation and bringing the texts into a listing shuffle
only the keys of the other side. A generation counts once its marker is written, after its rows; rows of a generation
that was cut short are never read. Catalog, schema and object names are not null."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ddlscope.functions.ddl import kind_from_ddl
from ddlscope.schemas import KEYS

MARKERS = "generation bigint, token string, objects bigint"


class Harvest:
    """The store at a path. `buckets` is fixed when it is made: some 100 MB of texts for each."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 200, lead: Sequence[str] = ()):
        self.spark, self.path, self.buckets, self.keys = spark, path.rstrip("/"), buckets, [*lead, *KEYS]
        # Buckets are known to a session's catalog only, so the files are named there.
        self.table = f"harvest_{hashlib.md5(self.path.encode()).hexdigest()}"
        columns = ", ".join(f"`{k}` STRING" for k in self.keys)
        folder = f"{self.path}/texts".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, ddl STRING, kind STRING, generation BIGINT, token STRING) USING parquet "
                  f"CLUSTERED BY ({', '.join(f'`{k}`' for k in self.keys)}) INTO {buckets} BUCKETS LOCATION '{folder}'")
        if not self._exists():
            spark.createDataFrame([], MARKERS).write.mode("append").parquet(f"{self.path}/markers")

    def _exists(self) -> bool:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/markers")
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(root)

    def markers(self) -> DataFrame:
        """One row for each generation that was added: its number, the token of its rows and how many there are."""
        return self.spark.read.schema(MARKERS).parquet(f"{self.path}/markers")

    def texts(self) -> DataFrame:
        """The keys, `ddl`, `kind` as the text names it, and generation of every object of the store: the last text, if there are several."""
        tokens = [r["token"] for r in self.markers().collect()]
        self.spark.catalog.refreshTable(self.table)
        rows = self.spark.table(self.table).where(F.col("token").isin(tokens))
        latest = F.max_by(F.struct("ddl", "kind", "generation"), "generation").alias("last")
        return rows.groupBy(*self.keys).agg(latest).select(*self.keys, "last.*")

    def known(self) -> DataFrame:
        """The keys of every object of the store; no text is read."""
        tokens = [r["token"] for r in self.markers().collect()]
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table).where(F.col("token").isin(tokens)).select(*self.keys)

    def remaining(self, selected: DataFrame) -> DataFrame:
        """The selected objects that have no text yet: the work of the next generation."""
        return selected.where("selected").join(self.known(), self.keys, "left_anti")

    def add(self, results: DataFrame, replace: bool = False) -> int:
        """Add the texts of one generation and return its number: those of objects that have none, or with `replace` all, which then
        stand for the earlier ones. Of an object that comes twice any text is kept, the greatest; null texts are left out."""
        new = results.where(F.col("ddl").isNotNull()).select(*self.keys, "ddl")
        if not replace:
            new = new.join(self.known(), self.keys, "left_anti")
        token, number = uuid.uuid4().hex, (self.markers().agg(F.max("generation")).first()[0] or 0) + 1
        rows = (new.groupBy(*self.keys).agg(F.max("ddl").alias("ddl")).repartition(self.buckets, *self.keys)
                .select(*self.keys, "ddl", kind_from_ddl("ddl").alias("kind"), F.lit(number).cast("bigint").alias("generation"), F.lit(token).alias("token")))
        rows.write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)
        count = self.spark.table(self.table).where(F.col("token") == token).count()
        marker = self.spark.createDataFrame([(number, token, count)], MARKERS)
        marker.coalesce(1).write.mode("append").parquet(f"{self.path}/markers")
        return number

    def write_back(self, listing: DataFrame) -> DataFrame:
        """Each listed object with its text and generation, and the kind that the text names, where there is one."""
        texts = self.texts().withColumnRenamed("kind", "ddl_kind")
        return (listing.select(*self.keys, "kind").join(texts, self.keys, "left")
                .withColumn("kind", F.coalesce("ddl_kind", "kind")).drop("ddl_kind"))
