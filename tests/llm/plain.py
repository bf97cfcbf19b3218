"""Plain versions of the operators' contracts, one text at a time, and inputs with the odd cases."""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import types as T

SPACE = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("n", T.LongType()), T.StructField("node", T.StringType()),
])

PROSE = "the quick brown fox jumps over the lazy dog and runs far away from all of the other animals in that green forest today "


def lower(text: str) -> str:
    return text.translate({c: c + 32 for c in range(0x41, 0x5B)})


def words(text: str | None) -> list[str]:
    return re.findall(SPACE, text or "")


def held_out(doc_id, folds: int, fold: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == fold


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def thue_morse(length: int = 2048) -> tuple[str, str]:
    """Two words that any polynomial hash modulo 2^64 takes for one."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(length))
    return one, one.translate(str.maketrans("ab", "ba"))


def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, ties, and columns that clash with the operators' own."""
    texts = [
        (1, PROSE * 3), (2, PROSE * 3), (2, PROSE * 3), (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "one two"), (None, PROSE * 3),
        (8, "ÄÖ é x y Straße 日本語 😀 it's \x00 end"), (9, "a" * 200_000), (10, PROSE * 4000), (11, "x\nx\nx\n\n x\ny"),
        (14, thue_morse()[0] + " x"), (15, thue_morse()[1] + " x"), (16, "\n".join(thue_morse())),
        (12, PROSE + "mail me at jo.do@mail.example.com or 10.0.0.255 now"), (None, None), (13, "1" * 5000 + "@" * 500),
    ]
    return spark.createDataFrame([(i, t, None, "s", None, "clash", 7, None) for i, t in texts], DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def read(spark, sf, table):
    return spark.read.parquet(f"{sf}/{table}.parquet")
