"""Detail sums landed in buckets of their parent, so that joins to them move no detail."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from faresettle.functions.values import sql_text
from faresettle.operators.details import VAT_BUCKETS, Details, add_details, vat_by_parent, yr_tax_by_parent

BATCH = "batch"
VAT_SUMS = tuple(VAT_BUCKETS)
YR_SUMS = ("yr_tmfa", "yr_tmff")


@dataclass(frozen=True)
class LandedDetails:
    """Two tables of sums per parent and landed batch, in ``buckets`` buckets of ``parent``.

    Lines are summed per parent before they land, with a map-side part, so a parent with very many lines costs a row per batch
    and its bucket is no larger than others. What reads the tables finds a parent's rows of all batches in one bucket.
    """

    spark: SparkSession
    vat: str
    tax: str
    parent: str
    buckets: int

    def land(self, details: Details, batch: str) -> None:
        """Sum and keep a batch of lines under its name; a batch of that name is replaced, so a rerun converges."""
        lines = details.lines()
        for table, sums in ((self.vat, vat_by_parent(lines.vat, details.parent)), (self.tax, yr_tax_by_parent(lines.tax, details.parent))):
            if self.spark.catalog.tableExists(table):
                self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({BATCH} = {sql_text(batch)})")
            named = sums.withColumnRenamed(details.parent, self.parent).withColumn(BATCH, F.lit(batch))
            dealt = named.repartition(self.buckets, self.parent)
            dealt.write.mode("append").partitionBy(BATCH).bucketBy(self.buckets, self.parent).sortBy(self.parent).saveAsTable(table)

    def sums(self, table: str, names: tuple[str, ...]) -> DataFrame:
        """One row per parent; rows of a parent lie in one bucket, so nothing moves."""
        return self.spark.table(table).groupBy(self.parent).agg(*[F.sum(name).alias(name) for name in names])

    def add_to(self, headers: DataFrame, key: str) -> DataFrame:
        """Left joins: headers without details stay, with null sums. Headers in as many buckets of ``key`` do not move either."""
        with_vat = add_details(headers, self.sums(self.vat, VAT_SUMS), key, self.parent)
        return add_details(with_vat, self.sums(self.tax, YR_SUMS), key, self.parent)

    def add_parts_to(self, headers: DataFrame, key: str) -> DataFrame:
        """``add_to``: landed sums are amounts."""
        return self.add_to(headers, key)
