"""The message envelope: UTF-8 keys, and values behind a five-byte header.

The header is one zero byte and the schema id as four big-endian bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.columns import named

HEADER_BYTES = 5
ID_HEADER = "message-id"


def strip_wire_header(value: Column) -> Column:
    """The payload behind the header."""
    return F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value) - HEADER_BYTES)


def schema_id(value: Column) -> Column:
    """The schema id the header names; null without a whole header that starts with a zero byte."""
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long")
    whole = (F.length(value) >= HEADER_BYTES) & (F.substring(value, 1, 1) == F.lit(b"\x00"))
    return F.when(whole, number)


def add_wire_header(payload: Column, schema_id: int) -> Column:
    """``payload`` behind a header that names ``schema_id``."""
    return F.concat(F.lit(b"\x00" + schema_id.to_bytes(4, "big")), payload)


def message_frame(
    df: DataFrame, key: Column, payload: Column, schema_id: int, id_cols: list[str] | None = None
) -> DataFrame:
    """Rows as ``(key, value)`` messages, ready for a topic sink.

    With ``id_cols``, the columns that tell a row from all others, each message also has
    ``headers`` with an id made of them. A row that is sent again, by a retried task or a
    repeated batch, is sent under the same id, and ``drop_repeats`` reads it once.
    """
    columns = [
        F.encode(key.cast("string"), "UTF-8").alias("key"),
        add_wire_header(payload, schema_id).alias("value"),
    ]
    if id_cols:
        columns.append(F.array(F.struct(F.lit(ID_HEADER).alias("key"), _id(id_cols).alias("value"))).alias("headers"))
    return df.select(*columns)


def _id(columns: list[str]) -> Column:
    # As JSON, so that neither nulls nor where one value ends can be mistaken.
    whole = F.to_json(F.struct(*[named(c) for c in columns]), {"ignoreNullFields": "false"})
    return F.unhex(F.sha2(whole, 256))


def message_id(headers: Column) -> Column:
    """The id in a message's headers; null without one."""
    own = F.filter(headers, lambda header: header["key"] == ID_HEADER)
    return F.try_element_at(own, F.lit(1))["value"]
