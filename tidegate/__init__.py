"""Config-driven ingestion, validation and event-time streaming on Spark.

Every operator takes and returns a ``DataFrame``; nothing here runs a job until
the caller writes, counts or starts a stream.
"""
