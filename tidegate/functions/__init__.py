from tidegate.functions.avro import decode_avro, encode_avro
from tidegate.functions.delimited import delimited_line, parse_delimited
from tidegate.functions.versions import decode_versions, is_known
from tidegate.functions.wire import (
    add_wire_header,
    message_frame,
    message_id,
    schema_id,
    strip_wire_header,
)

__all__ = [
    "add_wire_header",
    "decode_avro",
    "decode_versions",
    "delimited_line",
    "encode_avro",
    "is_known",
    "message_frame",
    "message_id",
    "parse_delimited",
    "schema_id",
    "strip_wire_header",
]
