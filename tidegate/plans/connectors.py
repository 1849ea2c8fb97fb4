"""Connector specs: what a job's ``src`` and ``target`` sections must hold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidegate.sinks import publish_file, read_published, write_file, write_table
from tidegate.sources import read_file, read_table

# The keys of a spec, by connector and by direction.
PLACE_KEYS = {
    "local_file": ("file_path", "file_type"),
    "postgres": ("conn_id", "schema", "db_table"),
}
DIRECTION_KEYS = {"source": ("read_props",), "sink": ("write_mode", "write_props")}
#: Asks a file sink for a new version behind a pointer, and a file source for the newest one.
PUBLISH = "publish"
RENAMED = {"conn_id": "db_conf_conn_id"}
# Not needed, but it spares a file source the pass that infers column types.
OPTIONAL_KEYS = {("local_file", "source"): ("schema",)}


@dataclass(frozen=True)
class Connector:
    """A checked spec: its type, its direction, and the arguments it comes down to."""

    connector_type: str
    direction: str
    arguments: dict[str, object]

    def read(
        self, spark: SparkSession, connections: Mapping[str, Mapping] | None = None
    ) -> DataFrame:
        """The dataset behind a source spec."""
        if self.direction != "source":
            raise ValueError("Cannot read from a sink")
        if self.connector_type == "local_file":
            props = dict(self.arguments["read_props"] or {})
            if props.pop("published", False):
                return read_published(spark, **{**self.arguments, "read_props": props})
            return read_file(spark, **self.arguments)
        return read_table(spark, *self._database(connections))

    def write(self, df: DataFrame, connections: Mapping[str, Mapping] | None = None) -> None:
        """Write ``df`` to the place a sink spec names."""
        if self.direction != "sink":
            raise ValueError("Cannot write to a source")
        if self.connector_type == "local_file" and self.arguments["write_mode"] == PUBLISH:
            publish_file(df, **{k: v for k, v in self.arguments.items() if k != "write_mode"})
        elif self.connector_type == "local_file":
            write_file(df, **self.arguments)
        else:
            write_table(df, *self._database(connections))

    def _database(self, connections: Mapping[str, Mapping] | None) -> tuple:
        name, *others = self.arguments.values()
        if name not in (connections or {}):
            raise KeyError(f"No connection is called {name!r}")
        return connections[name], *others


def connector(direction: str, raw: Mapping[str, object]) -> Connector:
    """Check one spec section and keep the settings its connector takes."""
    if direction not in DIRECTION_KEYS:
        raise ValueError(f"A connector is a source or a sink, not {direction!r}")
    if "connector_type" not in raw:
        raise ValueError("The spec names no connector_type")
    kind = raw["connector_type"]
    if kind not in PLACE_KEYS:
        raise ValueError(f"No connector is called {kind!r}; there are {tuple(PLACE_KEYS)}")
    keys = PLACE_KEYS[kind] + DIRECTION_KEYS[direction]
    missing = [key for key in keys if key not in raw]
    if missing:
        raise ValueError(f"The {kind} {direction} spec lacks {', '.join(missing)}")
    keys += tuple(key for key in OPTIONAL_KEYS.get((kind, direction), ()) if key in raw)
    return Connector(kind, direction, {RENAMED.get(key, key): raw[key] for key in keys})
