"""Parquet layers on a shared file system: raw, dw, mart. One folder per table."""

from __future__ import annotations

import json
import os
import uuid

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from orderlens.schema import RAW_SCHEMAS
from orderlens.sources.adapter import RawTables


def read_raw(spark: SparkSession, raw_dir: str) -> RawTables:
    """The nine raw tables stored as Parquet under ``raw_dir/<table>``, with their declared schema."""
    def load(name: str) -> DataFrame:
        return spark.read.schema(RAW_SCHEMAS[name]).parquet(os.path.join(raw_dir, name))
    return RawTables(spark, load)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def plain_columns(schema: T.StructType) -> dict[str, str]:
    """Write options: ids and timestamps, whose values hardly repeat, are stored without a Parquet dictionary. A writer would
    look every value up in one that it gives up once it is full."""
    return {f"parquet.enable.dictionary#{f.name}": "false" for f in schema.fields
            if f.name.endswith("_id") or isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}


class Layer:
    """A folder of Parquet tables (``<root>/<name>``)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str) -> bool:
        return path_exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """Full refresh (truncate + load / drop + create-as): write, then read back the stored table."""
        df.write.mode("overwrite").options(**plain_columns(df.schema)).parquet(self.path(name))
        return self.read(name)

    def overwrite_observed(self, name: str, df: DataFrame, metrics: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
        """:meth:`overwrite`, and a one-row frame of ``metrics`` (named aggregates, no distinct ones) over the rows written.

        They are taken by the tasks that write, so the table isn't read for them. They stand right below the write,
        in the stage whose tasks each count once, also when one is run again. A plan that Spark proves empty observes
        nothing: then the stored (empty) table is asked.
        """
        seen = Observation()
        stored = self.overwrite(name, df.observe(seen, *metrics))
        asked = stored.agg(*metrics)
        found = seen.get
        if not found:
            return stored, asked
        return stored, self.spark.createDataFrame([tuple(found[c] for c in asked.columns)], asked.schema)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        df.write.mode("append").options(**plain_columns(df.schema)).parquet(self.path(name))
        return self.read(name)


class Versions:
    """Published sets of tables: a folder for every run, and a manifest that names the tables of one run.

    A run writes its tables below :meth:`new` and publishes them by one new file in ``<root>/manifests``, written elsewhere
    and renamed into place; readers take the manifest with the greatest number. Until then, and if the run stops, they see the
    set before, whole. One writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _numbers(self) -> list[int]:
        fs, p = self._fs(f"{self.root}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def _tables(self, number: int) -> dict[str, str]:
        text = "".join(r[0] for r in self.spark.read.text(f"{self.root}/manifests/{number:010d}.json", wholetext=True).collect())
        return json.loads(text)["tables"]

    def new(self) -> str:
        """A folder that no other run uses."""
        return f"{self.root}/versions/{uuid.uuid4().hex}"

    def current(self) -> dict[str, str]:
        """Table -> path of the published set."""
        numbers = self._numbers()
        if not numbers:
            raise FileNotFoundError(f"nothing is published below {self.root}")
        return self._tables(numbers[-1])

    def publish(self, tables: dict[str, str], keep: int = 2) -> int:
        """Switch readers to ``tables``; returns the manifest's number. Manifests older than the last ``keep`` go, and the version
        folders that no kept one names (of old runs, and of runs that stopped); readers of the set before can finish."""
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 1
        fs, temporary = self._fs(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = fs.create(temporary)
        out.write(bytearray(json.dumps({"tables": tables}).encode()))
        out.close()
        place = self._fs(f"{self.root}/manifests/{number:010d}.json")[1]
        if not fs.rename(temporary, place):
            raise RuntimeError(f"manifest {number} could not be put in place")
        kept = [n for n in numbers if n > number - keep] + [number]
        for n in numbers:
            if n not in kept:
                old, p = self._fs(f"{self.root}/manifests/{n:010d}.json")
                old.delete(p, False)
        used = "\n".join(path for n in kept for path in self._tables(n).values())
        for status in fs.listStatus(self._fs(f"{self.root}/versions")[1]):
            if f"/versions/{status.getPath().getName()}/" not in used:
                fs.delete(status.getPath(), True)
        return number
