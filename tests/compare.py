"""Compare a registered query with its SQL, whatever the order of rows."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def value(cell):
    """A cell in a form both engines agree on."""
    if isinstance(cell, float):
        return format(cell, ".9g")
    if isinstance(cell, Decimal):
        return format(cell, "f")
    if isinstance(cell, datetime):
        return cell.isoformat()
    if isinstance(cell, (bytes, bytearray)):
        return bytes(cell).hex()
    return str(cell)


def bag(columns, rows):
    """The column names in order, and how often each row occurs."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(value(row[i]) for i in order) for row in rows
    )


def spark_bag(df):
    return bag(df.columns, df.collect())


def sql_bag(sf_dir, sql):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    result = connection.execute(sql)
    return bag([column[0] for column in result.description], result.fetchall())
