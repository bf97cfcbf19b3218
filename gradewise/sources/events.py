"""Loan events as JSON text, for any message transport."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradewise.schemas import EVENT_SCHEMA

_CORRUPT = "_corrupt"


def to_events(staged: DataFrame, limit: int | None = None) -> DataFrame:
    """Staged loans as events: `key` (the loan id) and `value` (JSON, NULL fields included).

    `limit` takes the first loans by id, then by all other fields, so that a repeated run sends the same
    ones even where ids repeat. Those rows pass through one task.
    """
    fields = [f.name for f in EVENT_SCHEMA]
    events = staged.select(*fields)
    if limit is not None:
        events = events.orderBy("loan_id", *[f for f in fields if f != "loan_id"]).limit(limit)
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return events.select(F.col("loan_id").alias("key"), body.alias("value"))


def _decode(messages: DataFrame, schema: T.StructType, value: str, keep: list[str]) -> DataFrame:
    """The kept columns, the schema's fields, and `_corrupt` where a record failed to parse."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    body = F.from_json(
        F.col(value).cast("string"),
        with_corrupt,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    # As a generator the decoding runs once per message. As a plain column it would be
    # copied into every later filter on its fields and run again there.
    return messages.select(*keep, F.inline(F.array(body)))


def _blank(value: str) -> Column:
    return F.coalesce(F.trim(F.col(value).cast("string")) == "", F.lit(True))


def _unreadable(schema: T.StructType) -> Column:
    """The record failed to parse and not one declared field survived."""
    failed = F.col(_CORRUPT).isNotNull()
    for field in schema:
        failed = failed & F.col(field.name).isNull()
    return failed


def parse_events(
    messages: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Decode JSON messages into the schema's columns, plus the `keep` columns of the message.

    A field of the wrong type becomes NULL and the rest of its record stays; a record that
    is no JSON object is dropped, and so is an empty message. Unknown fields are ignored.
    """
    decoded = _decode(messages.where(~_blank(value)), schema, value, list(keep))
    return decoded.where(~_unreadable(schema)).drop(_CORRUPT)


def reject_events(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA, value: str = "value") -> DataFrame:
    """The messages that parse_events drops, unchanged."""
    message = F.struct(*messages.columns).alias("_message")
    decoded = _decode(messages.select(message, F.col(value).alias("_value")), schema, "_value", ["_message", "_value"])
    return decoded.where(_blank("_value") | _unreadable(schema)).select("_message.*")
