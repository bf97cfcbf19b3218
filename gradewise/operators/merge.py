"""Insert-only merge: append the batch rows whose key the target does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_per_key(batch: DataFrame, key: str = "row_hash") -> DataFrame:
    """One row per key, the smallest by its other columns so that reruns agree; rows without a key all stay.

    An aggregate, not a window: copies of a key are reduced before the shuffle, so no task
    has to hold all copies of a frequent one.
    """
    rest = [c for c in batch.columns if c != key]
    smallest = batch.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    unpacked = smallest.select(*[F.col(key) if c == key else F.col(f"_row.{c}") for c in batch.columns])
    return unpacked.unionByName(batch.where(F.col(key).isNull()))


def new_keys(batch: DataFrame, target: DataFrame | None, key: str = "row_hash") -> DataFrame:
    """The batch's keys that the target lacks, each once.

    Copies of a key are reduced before they are exchanged, so a frequent key weighs no more than another. Of the
    target only the key column is read. A table bucketed by the key (`sources.keys`) isn't exchanged at all; any
    other target's keys are.
    """
    keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
    if target is None:
        return keys
    held = target.select(F.col(key).alias("_key"))
    return keys.join(held, F.col(key) == F.col("_key"), "left_anti")


def with_keys(batch: DataFrame, keys: DataFrame, key: str = "row_hash") -> DataFrame:
    """Batch rows whose key is among `keys`, and those without a key, which are always new.

    If `keys` is stored, both sides of the join come straight from their scans, in the form in which adaptive
    execution can split a frequent key or broadcast few keys.
    """
    found = batch.join(keys.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_semi")
    return found.unionByName(batch.where(F.col(key).isNull()))


def new_rows(
    batch: DataFrame,
    target: DataFrame | None,
    key: str = "row_hash",
    dedupe_batch: bool = False,
    keys_path: str | None = None,
) -> DataFrame:
    """Rows of `batch` whose key is not in `target` (None: there is none yet); a NULL key is never in it.

    Copies of a new key inside the batch are all kept unless `dedupe_batch` is set. With `keys_path` the new keys
    are stored there first (the caller deletes it), for `with_keys` and for a side table of keys.
    """
    if dedupe_batch:
        batch = one_row_per_key(batch, key)
    if target is None and keys_path is None:
        return batch
    keys = new_keys(batch, target, key)
    if keys_path is not None:
        keys.write.parquet(keys_path)
        keys = batch.sparkSession.read.schema(keys.schema).parquet(keys_path)
    return batch if target is None else with_keys(batch, keys, key)
