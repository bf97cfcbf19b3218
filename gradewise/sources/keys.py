"""The keys of a raw table, in a table of their own that is bucketed by key.

A merge asks which of a batch's keys the raw table has. The side table answers it with the batch's keys alone
exchanged: its files lie in buckets of the hash that the exchange uses, so it is read where it lies, and nothing else of
the raw table is.

The folder `<raw>_keys` holds one version, `v<number>-<buckets>`. While a load runs, a mark lies beside it: rows are
written first, their keys after them. A load that dies in between leaves the mark, and the next one builds the keys
anew from the raw table before it trusts them. A version counts once Spark has finished writing it.
Rows that come into the raw table by another way than a merge call for `build_keys`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradewise.session import delete_path, list_folder, path_exists, whole_path, write_text

KEY = "row_hash"
# A bucket is one unit of work of a merge.
KEYS_PER_BUCKET = 5_000_000
LEAST_BUCKETS = 16
_VERSION = re.compile(r"v(\d+)-(\d+)")
_MARK = "_loading"


def key_folder(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}_keys"


def _versions(spark: SparkSession, raw_path: str) -> list[tuple[int, int, str]]:
    """(number, buckets, path) of what lies in the folder, newest last; finished ones only."""
    found = []
    for name in list_folder(spark, key_folder(raw_path)):
        path = f"{key_folder(raw_path)}/{name}"
        if (m := _VERSION.fullmatch(name)) and "_SUCCESS" in list_folder(spark, path):
            found.append((int(m[1]), int(m[2]), path))
    return sorted(found)


def _table(path: str) -> str:
    return f"gradewise_keys_{hashlib.md5(path.encode()).hexdigest()}"


def _declared(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    # Buckets are known to the catalog only, so each session declares the table over the files.
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_table(path)} ({KEY} STRING) USING parquet "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    spark.catalog.refreshTable(_table(path))
    return spark.table(_table(path))


def _write(keys: DataFrame, path: str, buckets: int) -> None:
    # Dealt out as the buckets are, so a load adds one file to each bucket it has keys for.
    dealt = keys.where(F.col(KEY).isNotNull()).select(KEY).repartition(buckets, KEY)
    dealt.write.mode("append").format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(_table(path))


def build_keys(spark: SparkSession, raw: DataFrame, raw_path: str, buckets: int | None = None) -> DataFrame:
    """The side table from the raw table's key column, in place of any older version; also to change the number of buckets."""
    keys = raw.select(KEY).where(F.col(KEY).isNotNull()).distinct()
    if buckets is None:
        buckets = max(LEAST_BUCKETS, -(-raw.select(KEY).count() // KEYS_PER_BUCKET))
    names = [m for n in list_folder(spark, key_folder(raw_path)) if (m := _VERSION.fullmatch(n))]
    path = whole_path(spark, f"{key_folder(raw_path)}/v{max((int(m[1]) for m in names), default=0) + 1}-{buckets}")
    _declared(spark, path, buckets)
    _write(keys, path, buckets)
    for m in names:
        old = whole_path(spark, f"{key_folder(raw_path)}/{m[0]}")
        spark.sql(f"DROP TABLE IF EXISTS {_table(old)}")
        delete_path(spark, old)
    return _declared(spark, path, buckets)


def held_keys(spark: SparkSession, raw: DataFrame, raw_path: str) -> DataFrame:
    """The keys of the raw table, from its side table; that is built first if there is none or a load died."""
    found = _versions(spark, raw_path)
    mark = f"{key_folder(raw_path)}/{_MARK}"
    if not found or path_exists(spark, mark):
        keys = build_keys(spark, raw, raw_path)
        delete_path(spark, mark)
        return keys
    _, buckets, path = found[-1]
    return _declared(spark, whole_path(spark, path), buckets)


def add_keys(spark: SparkSession, keys: DataFrame, raw_path: str) -> None:
    """Add a load's new keys; each must be new and there once."""
    _, buckets, path = _versions(spark, raw_path)[-1]
    path = whole_path(spark, path)
    _declared(spark, path, buckets)
    _write(keys, path, buckets)


@contextmanager
def loading(spark: SparkSession, raw_path: str) -> Iterator[None]:
    """Marks the time between a load's first row and its last key; the mark stays if the load dies."""
    mark = f"{key_folder(raw_path)}/{_MARK}"
    write_text(spark, mark)
    yield
    delete_path(spark, mark)
