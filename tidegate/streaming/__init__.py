from tidegate.streaming.late_buffer import hold_late_records, rocksdb_state
from tidegate.streaming.late_records import late_records_to_files, route_late_records
from tidegate.streaming.late_split import merge_spans, read_spans, split_late_stream
from tidegate.streaming.offset_ledger import (
    OffsetLedger,
    committed_offsets,
    read_ledger,
    starting_offsets,
)
from tidegate.streaming.repeats import drop_repeats
from tidegate.streaming.writers import write_text_stream, write_windows_csv

__all__ = [
    "OffsetLedger",
    "committed_offsets",
    "drop_repeats",
    "hold_late_records",
    "late_records_to_files",
    "merge_spans",
    "read_ledger",
    "read_spans",
    "rocksdb_state",
    "route_late_records",
    "split_late_stream",
    "starting_offsets",
    "write_text_stream",
    "write_windows_csv",
]
