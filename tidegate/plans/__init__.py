from tidegate.plans.connectors import connector
from tidegate.plans.ingest import ingest, ingest_all
from tidegate.plans.runs import read_run, run_jobs
from tidegate.plans.streams import (
    decode_messages,
    on_time_to_text,
    unknown_messages,
    unknown_to_files,
    windows_to_csv,
)

__all__ = [
    "connector",
    "decode_messages",
    "ingest",
    "ingest_all",
    "on_time_to_text",
    "read_run",
    "run_jobs",
    "unknown_messages",
    "unknown_to_files",
    "windows_to_csv",
]
