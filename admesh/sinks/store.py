"""A Parquet table in hash buckets of its key, updated bucket by bucket."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from admesh.storage import RunFolder

BUCKET = "bucket"


class Store:
    """Rows kept under ``path``, one directory for each of ``buckets`` hash buckets of ``key``.

    An update writes the buckets that hold its keys and leaves the files of all
    others alone (dynamic partition overwrite). New rows are written to the run's
    folder first, so that a bucket is never read and overwritten in one job, and
    a retry of the overwrite gives the same rows. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema, key: str = "id", buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame) -> None:
        """Replace the buckets that ``rows`` fall into; the first write creates the table."""
        # Buckets are dealt out whole and their rows sorted, so a bucket is one file with narrow key ranges.
        (rows.withColumn(BUCKET, self.bucket()).repartition(self.buckets, BUCKET).sortWithinPartitions(BUCKET, self.key)
         .write.partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path))

    def exists(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets, whose directories alone are then scanned."""
        stored = self.spark.read.schema(self.schema).parquet(self.path)
        stored = stored if buckets is None else stored.filter(F.col(BUCKET).isin(buckets))
        return stored.drop(BUCKET)

    def touched(self, updates: DataFrame) -> list[int]:
        """The buckets that hold the updates' keys: at most as many numbers as there are buckets."""
        return sorted(r[0] for r in updates.select(self.bucket()).distinct().collect())

    def update(self, updates: DataFrame, change, run: RunFolder) -> list[int]:
        """Write ``change(old rows)`` to the buckets of the updates' keys, and return these buckets.

        ``updates`` is read several times, so pass a table rather than a query.
        """
        buckets = self.touched(updates)
        if buckets:
            self.write(run.write(change(self.read(buckets)), "changed"))
        return buckets

    def upsert(self, rows: DataFrame, keys: list[str], run: RunFolder) -> list[int]:
        """Put in ``rows``, each in place of the stored one with the same ``keys``; NULL keys are equal."""
        if not self.exists():
            self.write(rows)
            return self.touched(rows)
        same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]

        def change(old):
            kept = old.alias("old").join(rows.select(*keys).alias("new"), same, "left_anti")
            return kept.unionByName(rows)
        return self.update(rows, change, run)
