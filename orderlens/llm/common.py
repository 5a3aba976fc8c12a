"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import checkpoint_dir, scratch_path

# ASCII white space as the contracts define it, for Java and RE2 regular expressions
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = "\t\n\x0b\x0c\r "


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; NULL counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a small frame; cuts the lineage and fixes its rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_key(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` stored with a unique number for every row, and the number's column: ids may be NULL or repeated."""
    key = "_row_key"
    while key in df.columns:
        key += "_"
    return stage(df.withColumn(key, F.monotonically_increasing_id()), name), key


def id_as_text(df: DataFrame) -> DataFrame:
    """``doc_id`` as text, for frames that go through pandas: a whole number beside a NULL would become
    floating point there and lose its last digits."""
    return df.withColumn("doc_id", F.col("doc_id").cast("string"))


def id_back(df: DataFrame, kind: str) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast(kind))


def held_out(doc_id: Column) -> Column:
    """The fold that learning never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(seed: int, *cols: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 of the seed and the columns."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
