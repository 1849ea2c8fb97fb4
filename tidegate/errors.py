"""Errors raised while data is moved."""


class ConnectorError(RuntimeError):
    """A source could not be read or a sink could not be written."""


class IngestError(RuntimeError):
    """At least one job of a run failed; ``outcomes`` holds all of them."""

    def __init__(self, failed: list[str], outcomes: dict):
        super().__init__(f"Ingestion failed for: {', '.join(failed)}")
        self.failed = failed
        self.outcomes = outcomes
