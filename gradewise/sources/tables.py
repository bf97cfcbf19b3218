"""Warehouse layers as Spark databases: `raw`, `staging`, `core`, `mart`."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from gradewise.schemas import LAYERS


def create_layers(spark: SparkSession, location: str | None = None) -> None:
    """Create the layer databases, under `location` if given. Names are used as they are."""
    for layer in LAYERS:
        where = f" LOCATION '{location.rstrip('/')}/{layer}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{where}")


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def _located(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def external_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """(Re)declare a table over Parquet files that stay where they are.

    Only a table that is itself external is replaced: dropping a managed one would delete its files.
    """
    quoted = _quoted(name)
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{name} exists and is {kind}, not EXTERNAL")
        spark.sql(f"DROP TABLE {quoted}")
    spark.sql(f"CREATE TABLE {quoted} USING parquet LOCATION '{_located(path)}'")
    # Folders of a partitioned layout have to be found once.
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {quoted}")
    return spark.table(quoted)


def register_raw(spark: SparkSession, path: str) -> DataFrame:
    """Declare the raw loan table of a folder as `raw.loans_raw`, where models look for it."""
    return external_table(spark, path, "raw.loans_raw")


def location(spark: SparkSession, name: str) -> str:
    """The folder of a table's files."""
    told = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").where("col_name = 'Location'")
    return told.first()["data_type"]


def add_months(spark: SparkSession, name: str, months: Iterable[str | None], column: str = "issue_month") -> None:
    """Make a load's partitions known to the catalog, without looking at the others; those it knows already stay as they are."""
    parts = [
        f"PARTITION ({column} = {'NULL' if month is None else repr(month)})"
        for month in dict.fromkeys(months)
    ]
    if parts:
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD IF NOT EXISTS {' '.join(parts)}")
        spark.catalog.refreshTable(_quoted(name))


def stored_view(spark: SparkSession, layer: str, name: str, query: str) -> DataFrame:
    """A view that is kept in the catalog, so that other sessions read it; recomputed when read."""
    spark.sql(f"CREATE OR REPLACE VIEW `{layer}`.`{name}` AS {query}")
    return source(spark, layer, name)


def external_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Session view over Parquet files."""
    spark.read.parquet(path).createOrReplaceTempView(name)
    return spark.table(name)


def source(spark: SparkSession, layer: str, table: str) -> DataFrame:
    """A table of a layer."""
    return spark.table(f"`{layer}`.`{table}`")


def materialize(df: DataFrame, name: str, kind: str, layer: str | None = None) -> DataFrame:
    """Publish a model as a `view` (recomputed when read) or a `table` (stored), and return it.

    A view of a DataFrame is a session view, since the catalog keeps SQL text and no plans, so it has no
    layer; `stored_view` makes one from SQL.
    """
    spark = df.sparkSession
    if kind == "view":
        if layer:
            raise ValueError("a view of a DataFrame belongs to the session; see stored_view")
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "table":
        full = f"`{layer}`.`{name}`" if layer else name
        df.write.mode("overwrite").format("parquet").saveAsTable(full)
        return spark.table(full)
    raise ValueError(f"kind must be 'view' or 'table', not {kind!r}")
