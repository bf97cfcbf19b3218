"""Running count of delinquent loans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gradewise.functions import grade_or_unknown, has_delinquency, round_stable
from gradewise.session import delete_path, scratch
from gradewise.streaming.sinks import BatchWriter, batch_ids

TOTALS = "grade string, total_loans bigint, delinquent_loans bigint"
REPORTS = "total_loans bigint, delinquent_loans bigint, delinquency_rate_pct double, by_grade map<string,bigint>"
# Spark's ids of rows: the partition above, the place in it below.
_PLACE_BITS = 33


def delinquency_by_grade(events: DataFrame) -> DataFrame:
    """Events and delinquent ones per grade: running totals on a stream (complete or update mode)."""
    return events.groupBy(grade_or_unknown(F.col("grade")).alias("grade")).agg(
        F.count("*").alias("total_loans"),
        F.count_if(has_delinquency(F.col("mths_since_last_delinq"))).alias("delinquent_loans"),
    )


def delinquency_totals(by_grade: DataFrame) -> DataFrame:
    """The one-line summary of the counts per grade."""
    total, delinquent = F.sum("total_loans"), F.sum("delinquent_loans")
    return by_grade.agg(
        F.coalesce(total, F.lit(0)).alias("total_loans"),
        F.coalesce(delinquent, F.lit(0)).alias("delinquent_loans"),
        F.coalesce(round_stable(F.try_divide(delinquent, total) * 100, 1), F.lit(0.0)).alias("delinquency_rate_pct"),
    )


def reports_every(path: str, every: int = 500, order: Sequence[str] = (), keep: int = 3) -> BatchWriter:
    """A writer of events that reports whenever the count of messages passes a multiple of `every`, from whatever source they come.

    Each batch adds to the counts that the batch before left in `path`/totals, and gives the reports due at the multiples it
    passes, in `path`/reports (see `reports` and `totals`). Messages count in the order of the columns `order` within a batch, or as they are read. No
    task sees a whole batch: places in the order come from the sizes of the partitions, and messages are tallied by report and grade before they
    are shuffled. A batch that is delivered again starts from the same counts and replaces its reports.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in batch_ids(spark, f"{root}/totals") if n < batch_id]
        before = spark.read.schema(TOTALS).parquet(f"{root}/totals/batch_id={earlier[-1]}") if earlier else spark.createDataFrame([], TOTALS)
        base = before.agg(F.coalesce(F.sum("total_loans"), F.lit(0))).first()[0]
        events = batch.select(
            grade_or_unknown(F.col("grade")).alias("grade"), has_delinquency(F.col("mths_since_last_delinq")).cast("long").alias("delinquent"), *order,
        )
        if order:
            events = events.repartitionByRange(*order).sortWithinPartitions(*order)
        with scratch(spark, "messages") as stored:
            events.select("grade", "delinquent", F.monotonically_increasing_id().alias("id")).write.parquet(stored)
            _report(spark.read.parquet(stored), before, base, every, root, batch_id)
        for old in batch_ids(spark, f"{root}/totals"):
            if old <= batch_id - keep:
                delete_path(spark, f"{root}/totals/batch_id={old}")

    return write


def _report(messages: DataFrame, before: DataFrame, base: int, every: int, root: str, batch_id: int) -> None:
    part = F.shiftright("id", _PLACE_BITS).alias("part")
    # One row for each partition of the batch.
    sizes = messages.groupBy(part).agg(F.count("*").alias("n"))
    behind = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("offset"))
    place = F.col("offset") + F.col("id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + F.lit(base + 1)
    tallies = messages.withColumn("part", F.shiftright("id", _PLACE_BITS)).join(F.broadcast(offsets), "part").groupBy(
        F.ceil(place / F.lit(every)).alias("report"), "grade",
    ).agg(F.count("*").alias("n"), F.sum("delinquent").alias("d"))
    # What was counted before belongs to the first report now due.
    held = before.select(F.lit(base // every + 1).cast("long").alias("report"), "grade", F.col("total_loans").alias("n"), F.col("delinquent_loans").alias("d"))
    tallies = tallies.unionByName(held).groupBy("report", "grade").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    so_far = Window.partitionBy("grade").orderBy("report")
    running = tallies.select(
        "report", "grade", F.sum("n").over(so_far).alias("n"), F.sum("d").over(so_far).alias("d"),
        F.lead("report").over(so_far).alias("next"),
    )
    now = messages.count() + base
    # A grade without messages for a report stands in it as in the one before.
    due = running.where(F.col("report") <= now // every).select(
        F.explode(F.sequence("report", F.least(F.coalesce(F.col("next") - 1, F.lit(now // every)), F.lit(now // every)))).alias("report"), "grade", "n", "d",
    )
    total, delinquent = F.sum("n"), F.sum("d")
    due.groupBy("report").agg(
        total.alias("total_loans"), delinquent.alias("delinquent_loans"),
        round_stable(F.try_divide(delinquent, total) * 100, 1).alias("delinquency_rate_pct"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("grade", "n")))).alias("by_grade"),
    ).drop("report").write.mode("overwrite").parquet(f"{root}/reports/batch_id={batch_id}")
    totals = tallies.groupBy("grade").agg(F.sum("n").alias("total_loans"), F.sum("d").alias("delinquent_loans"))
    totals.coalesce(1).write.mode("overwrite").parquet(f"{root}/totals/batch_id={batch_id}")


def reports(spark: SparkSession, path: str) -> DataFrame:
    """The reports that `reports_every` has given: total_loans, delinquent_loans, delinquency_rate_pct, by_grade."""
    return spark.read.schema(REPORTS).parquet(f"{path.rstrip('/')}/reports").drop("batch_id")


def totals(spark: SparkSession, path: str) -> DataFrame:
    """The counts per grade behind the last batch, as `delinquency_by_grade` gives them."""
    folder = f"{path.rstrip('/')}/totals"
    return spark.read.schema(TOTALS).parquet(f"{folder}/batch_id={batch_ids(spark, folder)[-1]}")
