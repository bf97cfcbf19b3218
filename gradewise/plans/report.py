"""Batch report: one scan of the loans, four result sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradewise.operators import reports
from gradewise.sources.files import read_parquet, save_results, write_parquet

REPORTS = {
    "default_by_grade": reports.default_rate_by_grade,
    "monthly_volume": reports.monthly_volume,
    "dpd_distribution": reports.dpd_distribution,
    "risk_tier_summary": reports.risk_tier_summary,
}


def report_frames(source: DataFrame) -> dict[str, DataFrame]:
    """The four reports of a set of loans or of a portfolio cube."""
    return {name: report(source) for name, report in REPORTS.items()}


def run_report(spark: SparkSession, loans_path: str, out: str, ts: str = "ingest_ts") -> dict[str, DataFrame]:
    """Read loans, store the portfolio cube and all reports under `out`, return the reports.

    The cube is the only thing computed from the loans. It is stored, not cached, so
    the reports survive the loss of an executor without a second scan.
    """
    cube_path = f"{out.rstrip('/')}/portfolio_cube"
    write_parquet(reports.portfolio_cube(read_parquet(spark, loans_path), ts), cube_path)
    frames = report_frames(read_parquet(spark, cube_path))
    paths = save_results(frames, out)
    return {name: read_parquet(spark, path) for name, path in paths.items()}


def add_load(loans: DataFrame, cubes: str, load: str, ts: str = "ingest_ts") -> None:
    """Tally a load's loans on their own and keep the tally; the same load again replaces it."""
    if not load or "/" in load:
        raise ValueError(f"a load's name is part of a path, not {load!r}")
    write_parquet(reports.portfolio_cube(loans, ts), f"{cubes.rstrip('/')}/load={load}")


def report_loads(spark: SparkSession, cubes: str, out: str) -> dict[str, DataFrame]:
    """The reports over all loads, from their stored tallies: no loan is read again."""
    cube = reports.merged_cube(read_parquet(spark, cubes))
    cube_path = f"{out.rstrip('/')}/portfolio_cube"
    write_parquet(cube, cube_path)
    frames = report_frames(read_parquet(spark, cube_path))
    paths = save_results(frames, out)
    return {name: read_parquet(spark, path) for name, path in paths.items()}
