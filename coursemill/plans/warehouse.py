"""Where the layered tables live: ``<root>/<layer>/<table>`` as partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from coursemill.plans.specs import ORDER_BUCKETS
from coursemill.sinks.tables import append_bucketed, write_files


@dataclass(frozen=True)
class Warehouse:
    root: str
    codec: str = "zstd"
    # prefix of the catalog names of bucketed tables, whose layout only the catalog knows
    catalog_prefix: str = ""
    # of bucketed tables; raise it with the data, as it is also the number of tasks that join them
    buckets: int = ORDER_BUCKETS

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table.replace('.', '/')}"

    def catalog_name(self, table: str) -> str:
        return self.catalog_prefix + table.replace(".", "_")

    def read(self, spark: SparkSession, table: str, dt: str | None = None, schema: str | None = None) -> DataFrame:
        """A table, or one ``dt`` of it: the filter prunes partitions before any file is opened.

        ``dt`` and ``dn`` are always text: they are read as such, as a value that has been a number once (site ``01``) is lost.
        """
        reader = spark.read.option("basePath", self.path(table))
        if not schema:
            found = reader.parquet(self.path(table)).schema
            schema = StructType([StructField(f.name, StringType() if f.name in ("dt", "dn") else f.dataType) for f in found])
        df = reader.schema(schema).parquet(self.path(table))
        return df if dt is None else df.where(F.col("dt") == dt)

    def write(
        self,
        df: DataFrame,
        table: str,
        partition_by: Sequence[str] = (),
        overwrite: bool = False,
        compact: bool = False,
        order_by: Sequence[Column | str] = (),
    ) -> None:
        write_files(
            df,
            self.path(table),
            partition_by=partition_by,
            overwrite=overwrite,
            codec=self.codec,
            compact=compact,
            order_by=order_by,
        )

    def append_bucketed(self, df: DataFrame, table: str, bucket_by: str, partition_by: Sequence[str]) -> None:
        append_bucketed(
            df,
            self.catalog_name(table),
            bucket_by=bucket_by,
            buckets=self.buckets,
            partition_by=partition_by,
            path=self.path(table),
        )

    def read_bucketed(self, spark: SparkSession, table: str, dt: str | None = None) -> DataFrame:
        df = spark.table(self.catalog_name(table))
        return df if dt is None else df.where(F.col("dt") == dt)
