"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that separate words: space and the control characters 09-0D.
SPACES = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or what
    ``SparkContext.setCheckpointDir`` was given.

    There is no default: a folder of one machine would lose what other machines write.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return d


def clean_up(spark: SparkSession) -> None:
    """Delete all intermediate tables that this package has written to the shared folder.

    Not while a result is still lazy: results read these tables.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/tenure-llm")
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tenure-llm/{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage: the plan is computed once, and a lost executor costs no
    recomputation of what stands before.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each lengthened by ``_`` until no column of ``df`` has it (in any case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def picked(df: DataFrame, **named: str) -> DataFrame:
    """Only the named columns of ``df`` under new names (``new="old"``); other columns cannot clash."""
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in named.items()])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, wherever Catalyst moves it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """The runs of ``[^\\x20\\x09-\\x0D]`` as an array (null and blank text: empty)."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def struct_of(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


def row_key(*cols: Column) -> Column:
    """A 128-bit key of a row's values (two differently seeded 64-bit hashes)."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit("second"), *cols).alias("b"))
