"""Messages of several schema versions in one topic.

Each message names the schema it was written with in its header. A topic's schemas are
given by id; every message is decoded with the schema it names and then brought into the
reader's schema: fields go by name or by the reader's aliases, whatever their order,
fields the reader lacks are left out, and fields the writer lacked take the reader's
default. Schemas that cannot be brought together fail when the plan is made, before a
message is read.
"""

from __future__ import annotations

import json
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidegate.functions.avro import decode_avro, record_fields, spark_avro_loaded, spark_type
from tidegate.functions.wire import schema_id, strip_wire_header


class IncompatibleSchemas(ValueError):
    """A writer's records have no reading under the reader's schema."""


def is_known(value: Column, schemas: dict[int, str]) -> Column:
    """Whether the message names one of ``schemas``; false without a header, and for null."""
    return F.coalesce(schema_id(value).isin(*schemas) if schemas else F.lit(False), F.lit(False))


def decode_versions(
    value: Column, schemas: dict[int, str], reader: str, mode: str = "FAILFAST"
) -> Column:
    """The message as a struct of the reader's fields; null where its schema is not known.

    ``schemas`` has the writers' schemas by id. Each distinct schema is decoded once, with
    the bodies of its own messages only, so a body that is malformed under its schema
    fails (or with ``mode='PERMISSIVE'`` is null) whatever other schemas make of it.
    """
    if not schemas:
        raise ValueError("Name at least one schema by its id")
    ids = defaultdict(list)
    for number, schema in schemas.items():
        ids[schema].append(number)
    named, body = schema_id(value), strip_wire_header(value)
    read = [
        _read(F.when(named.isin(*numbers), body), writer, reader, mode) for writer, numbers in ids.items()
    ]
    return F.coalesce(*read)


def _read(body: Column, writer: str, reader: str, mode: str) -> Column:
    if spark_avro_loaded():
        from pyspark.sql.avro.functions import from_avro

        return from_avro(body, writer, {"mode": mode, "avroSchema": reader})
    written = decode_avro(body, writer, mode)
    if json.loads(writer) == json.loads(reader):
        return written
    return F.when(written.isNotNull(), F.struct(*resolved(written, writer, reader)))


def resolved(written: Column, writer: str, reader: str) -> list[Column]:
    """The reader's fields, taken from a struct of the writer's or from their defaults."""
    kinds = {name: (kind, args) for name, kind, args in record_fields(writer)}
    declared = json.loads(reader)["fields"]
    fields = []
    for field, (name, kind, args), out in zip(
        declared, record_fields(reader), spark_type(record_fields(reader)), strict=True
    ):
        source = next((n for n in (name, *field.get("aliases", [])) if n in kinds), None)
        if source is not None:
            if kinds[source] != (kind, args):
                raise IncompatibleSchemas(f"Field {name} is {kind} {args}, but was written as {kinds[source]}")
            column = written.getField(source)
        elif "default" in field:
            column = _default(field["default"], kind, args)
        else:
            raise IncompatibleSchemas(f"Field {name} was not written and has no default")
        fields.append(column.cast(out.dataType).alias(name))
    return fields


def _default(value, kind: str, args: tuple[int, ...]) -> Column:
    """A default as the schema states it: times as ticks, decimals as the text of their bytes."""
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(int(value) * args[0]).cast("long"))
    if kind == "decimal":
        unscaled = int.from_bytes(value.encode("latin-1"), "big", signed=True)
        return F.lit(Decimal(unscaled).scaleb(-args[1]))
    return F.lit(value)


def readable(schemas: dict[int, str], reader: str) -> dict[int, str]:
    """Those of ``schemas`` that can be brought into the reader's; asks no message.

    Use it where a topic's history holds versions that this reader may leave to
    the route of the unknown.
    """

    def fits(writer: str) -> bool:
        try:
            resolved(F.lit(None), writer, reader)
        except IncompatibleSchemas:
            return False
        return True

    verdicts = {writer: fits(writer) for writer in set(schemas.values())}
    return {number: writer for number, writer in schemas.items() if verdicts[writer]}

