"""Quality figures of any span of days, from one small row a day.

Per day are kept: rows, values, a sketch of the distinct keys and one of the measure's distribution. Sketches of
days merge, so the figures of a span need its days' rows and none of the table's. Counts of rows and values are
exact. The number of distinct keys is within 5 % (three standard errors of 4,096 buckets), and the rank of a
quantile within 3 of 100.

A day is replaced as a whole, so a revision that brings all rows of its days gives the same figures as a new start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, LongType, StringType, StructField, StructType

from ..sources.versions import Manifest, VersionedTable, Versions, name_of

LG_BUCKETS = 12
DISTINCT_ERROR = 0.05
RANK_ERROR = 0.03

SCHEMA = StructType(
    [
        StructField("day", DateType()),
        StructField("n_rows", LongType()),
        StructField("n_values", LongType()),
        StructField("keys", BinaryType()),
        StructField("measure", BinaryType()),
        StructField("month", StringType()),
    ]
)


@dataclass(frozen=True)
class DailyQuality:
    """The daily rows of one feed, below a folder. `key` is cast to text, `measure` to double."""

    spark: SparkSession
    folder: str
    day: str
    key: str
    measure: str

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(Versions(self.spark, self.folder), "quality", SCHEMA, "month")

    def daily(self, rows: DataFrame) -> DataFrame:
        """One row a day, combined on the map side."""
        value = F.col(self.measure).cast("double")
        return (
            rows.withColumn("_day", F.to_date(self.day))
            .groupBy(F.col("_day").alias("day"))
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count(value).alias("n_values"),
                F.hll_sketch_agg(F.col(self.key).cast("string"), LG_BUCKETS).alias("keys"),
                F.kll_sketch_agg_double(value).alias("measure"),
            )
            .withColumn("month", F.date_format("day", "yyyy-MM"))
        )

    def publish(self, rows: DataFrame) -> Manifest:
        """Replaces the days that rows holds; these must be all rows of their days."""
        base = self.table.versions.current()
        new = self.daily(rows)
        months = {name_of(r[0]) for r in rows.select(F.date_format(F.to_date(self.day), "yyyy-MM")).distinct().collect()}  # calendar months
        others = self.table.read(base, months).join(rows.select(F.to_date(self.day).alias("_day")).distinct(), F.col("day").eqNullSafe(F.col("_day")), "left_anti")
        return self.table.publish(new.unionByName(others), base)

    def spans(self, spans: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
        """spans (first, last) with n_rows, n_values, n_keys and the measure's quantiles; days are met by equality."""
        each = spans.select("first", "last").distinct().withColumn("day", F.explode(F.when(F.col("first") <= F.col("last"), F.sequence("first", "last"))))
        kept = each.join(self.table.read().drop("month"), "day")
        sums = kept.groupBy("first", "last").agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_values").alias("n_values"),
            F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("n_keys"),
            F.kll_merge_agg_double(F.when(F.col("n_values") > 0, F.col("measure"))).alias("_measure"),
        )
        values = [F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("_measure", F.lit(float(q)))).alias(f"q{round(100 * q)}") for q in quantiles]
        return sums.select("first", "last", "n_rows", "n_values", "n_keys", *values)
