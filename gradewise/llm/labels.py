"""Labelled rows for the trained operators: a bounded, repeatable sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A classifier sees at most this many labelled documents, those with the smallest hash of their id.
SAMPLE_ROWS = 4000


def held_out(doc_id: str | Column, folds: int = 5, fold: int = 0) -> Column:
    """True where crc32(id as text) mod `folds` is `fold`; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def sample(
    docs: DataFrame, labels: DataFrame, target: str, *, rows: int = SAMPLE_ROWS, folds: int = 5,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(`id`, `text`, `label`) of at most `rows` labelled documents outside the held-out fold.

    A null label or id isn't used; of several labels of one document the largest counts, of several texts one. The ids
    are chosen first, so only the chosen texts are read on.
    """
    chosen = (
        labels.where(F.col(target).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, folds))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(target).alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most `rows` ids. Of several texts with one id the one with the smallest hash counts, so there are no more rows either.
    found = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(
        F.min(F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("one"),
    )
    return found.select("id", F.col("one.text").alias("text"), F.col("label").cast("double").alias("label"))
