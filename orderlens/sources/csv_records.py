"""Records of CSV files whose quoted fields hold newlines, read by many tasks a file.

Spark's ``multiLine`` reader gives a file to one task, as it can't know whether a line break in the middle of a file ends a record.
Quotes tell: they come in pairs (a quote inside a field is doubled), so a line break ends a record where the number of
quotes before it, from the file's start, is even. Three steps, all over Spark's own splits of the files into byte
ranges and lines:

1. the parity of the quotes of every range, by one aggregation (a row per range);
2. a prefix sum of these per file: is a field open where the range begins?
3. every range joins its lines to records. The piece at its end that another range completes, and the piece
   at its beginning that completes an earlier one, are put together by file; these are two a range at most.

The files are read once for step 1 and twice for step 3 (whole records, pieces), each time in parallel.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# what a range makes of its lines: a whole record, the end of an earlier range's record, a stretch inside one, the beginning of one
WHOLE, END, MIDDLE, BEGIN = range(4)
_QUOTED = re.compile(r'"[^"]*"')
_PIECES = "path string, start long, piece int, header boolean, record string"


def _finished(record: str) -> str:
    """Without the carriage return of a line that ends in one; files with bare carriage returns as line ends are refused."""
    record = record[:-1] if record.endswith("\r") else record
    if "\r" in record and "\r" in _QUOTED.sub("", record):
        raise ValueError("a carriage return outside quotes: lines must end in \\n or \\r\\n")
    return record


def _assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines (path, start of the range, open: does it begin inside quotes, value) in order, to pieces of records."""
    at, lines, inside, head, header = None, [], False, False, False

    def rest():
        return [(*at, MIDDLE if head else BEGIN, header, "\n".join(lines))] if lines else []

    for b in batches:
        out = []
        for path, start, opened, value in zip(b["path"], b["start"], b["open"], b["value"]):
            if (path, start) != at:
                out += rest()
                at, lines, inside, head, header = (path, start), [], bool(opened), bool(opened), start == 0
            lines.append(value)
            if value.count('"') & 1:
                inside = not inside
            if not inside:
                record = "\n".join(lines)
                out.append((*at, END, header, record) if head else (*at, WHOLE, header, _finished(record)))
                lines, head, header = [], False, False
        if out:
            yield pd.DataFrame(out, columns=["path", "start", "piece", "header", "record"])
    if lines:
        yield pd.DataFrame(rest(), columns=["path", "start", "piece", "header", "record"])


def _stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pieces by path, start and kind, to whole records."""
    path, parts, header = None, [], False

    def unfinished():
        return ValueError(f"{path} ends inside quotes")

    for b in batches:
        out = []
        for p, start, piece, first, record in zip(b["path"], b["start"], b["piece"], b["header"], b["record"]):
            if p != path and parts:
                raise unfinished()
            path = p
            if piece == BEGIN:
                parts, header = [record], first
            else:
                parts.append(record)
            if piece == END:
                out.append((p, start, WHOLE, header, _finished("\n".join(parts))))
                parts = []
        if out:
            yield pd.DataFrame(out, columns=["path", "start", "piece", "header", "record"])
    if parts:
        raise unfinished()


def quoted_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of CSV files (quote and escape ``"``), without each file's header and without empty lines: one column
    ``record``, whose order is not that of the files. A file that ends inside quotes fails, as does one whose
    lines end in a bare carriage return."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    ranges = lines.groupBy("path", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = ranges.select("path", "start", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("open"))
    # one row per range: a proven bound for the broadcast, which leaves the lines in their order. A range that the
    # first scan did not see (the scans were split differently) fails
    known = lines.join(F.broadcast(opened), ["path", "start"], "left").select("path", "start", "value", F.when(
        F.col("open").isNull(), F.raise_error(F.lit("the files were split anew during the read"))).otherwise(F.col("open")).alias("open"))
    pieces = known.mapInPandas(_assemble, _PIECES)
    broken = pieces.filter(F.col("piece") != WHOLE).repartition("path").sortWithinPartitions("path", "start", "piece")
    whole = pieces.filter(F.col("piece") == WHOLE).unionByName(broken.mapInPandas(_stitch, _PIECES))
    return whole.filter(~F.col("header") & (F.col("record") != "")).select("record")
