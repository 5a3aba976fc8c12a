"""Typed CSV ingestion with the semantics of a PostgreSQL ``COPY … (FORMAT csv, HEADER, QUOTE '"', ESCAPE '"')``.

* columns bind by position to the declared schema; the header line is skipped;
* an unquoted empty field is NULL, a quoted empty field is the empty string;
* ``""`` inside quotes is one ``"``; a quoted field may hold newlines (``multiline`` tables), which are kept as they are;
* a malformed row aborts the load (``FAILFAST``), as COPY does.

Files are split over many tasks: line by line where no field holds a newline, else (review texts) by
:mod:`orderlens.sources.csv_records`, which finds the records' borders inside a file. Loads are written to Parquet with
all columns, so later reads get column pruning and pushdown.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schema import RAW_SCHEMAS
from orderlens.sources.csv_records import quoted_records

# a string that never occurs in the data, so only unquoted empties (not a literal) become NULL
_NULL_SENTINEL = "\u0000\u0001orderlens-null\u0001\u0000"
MULTILINE_TABLES = frozenset({"order_reviews"})


_COPY_OPTIONS = {
    "quote": '"', "escape": '"', "mode": "FAILFAST", "nullValue": _NULL_SENTINEL, "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_csv(spark: SparkSession, path: str | list[str], table: str, multiline: bool | None = None) -> DataFrame:
    """Read one raw table from CSV with its declared schema.

    ``multiline=True`` reads quoted newlines with one task a file (Spark's own reader), ``False`` line by line; by default
    tables with newlines in their texts are read by many tasks a file, all others line by line.
    """
    schema = RAW_SCHEMAS[table]
    if multiline is None and table in MULTILINE_TABLES:
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        return quoted_records(spark, path).select(F.from_csv("record", ddl, _COPY_OPTIONS).alias("r")).select("r.*")
    return (spark.read.schema(schema).options(header=True, enforceSchema=True, multiLine=bool(multiline), **_COPY_OPTIONS)
            .csv(path))


def default_paths(csv_dir: str, tables: Iterable[str] = RAW_SCHEMAS) -> dict[str, str]:
    """``<csv_dir>/<table>.csv`` for each raw table."""
    return {t: os.path.join(csv_dir, f"{t}.csv") for t in tables}


def ingest(spark: SparkSession, paths: Mapping[str, str], out_dir: str) -> dict[str, str]:
    """Full refresh of the raw layer: each CSV is read and written as Parquet (overwrite).

    Every column is written, so a bad value in any column fails the load (CSV column pruning would
    otherwise skip parsing columns nobody reads).
    """
    written = {}
    for table, path in paths.items():
        df = read_csv(spark, path, table)
        target = os.path.join(out_dir, table)
        df.write.mode("overwrite").parquet(target)
        written[table] = target
    return written
