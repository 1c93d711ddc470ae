"""Written intermediates: they cut the lineage and outlive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from parcelgrid.session import register, shared_path

#: Shuffle files of a finished write are of no further use; Spark then drops them at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Kept:
    """A table in the shared folder, dropped again once nothing reads it."""

    def __init__(self, df: DataFrame, label: str) -> None:
        spark = df.sparkSession
        self.path = register(shared_path(spark, label))
        before = spark.conf.get(CLEANUP, None)
        spark.conf.set(CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(self.path)
        finally:
            spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
        self.df = spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        """Delete the files; only for tables that no later plan reads."""
        spark = self.df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
