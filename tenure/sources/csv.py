"""CSV and directory sources — SURVEY A9-A12.

``read_csv_records``: header row, every column a string, values trimmed of all
white space, all-blank rows dropped, headers cleaned of BOM/NUL characters and
checked (non-empty, unique, <= 100 chars). Files of a folder may have their
columns in different orders and their own encodings: a task reads each file whole,
finds its encoding from all its bytes and its header, and gives its records as
maps, so the plan has one scan however many files there are; only the distinct
header names come to the driver.
"""

from __future__ import annotations

import csv as _csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalise_name

BOM_CHARS = "\ufeff\ufffe\x00"
MAX_HEADER_LEN = 100
# Byte order marks and their encodings; a file without one that is no UTF-8 is read as the fallback.
BOMS = ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16"))
#: Records that a task gives at once.
BATCH = 2_000


def clean_header(name: str) -> str:
    return "".join(ch for ch in str(name) if ch not in BOM_CHARS).strip()


def validate_headers(names: list[str]) -> list[str]:
    """Header validation (B49): non-empty, unique, each <= 100 characters."""
    problems = []
    seen = set()
    for n in names:
        if not n:
            problems.append("empty header")
        elif len(n) > MAX_HEADER_LEN:
            problems.append(f"header too long: {n[:20]}...")
        elif n in seen:
            problems.append(f"duplicate header: {n}")
        seen.add(n)
    return problems


def detect_encoding(content: bytes, fallback: str = "cp1252") -> str:
    """Encoding of a file (A10): by its byte order mark, else UTF-8 where all of it is valid UTF-8, else ``fallback``."""
    for mark, name in BOMS:
        if content.startswith(mark):
            return name
    try:
        content.decode("utf-8")
    except UnicodeDecodeError:
        return fallback
    return "utf-8"


def _any_value(names: list[str]) -> Column:
    """Whether one of the columns isn't blank (an array, so that wide files make no deep expression)."""
    return F.exists(F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in names]), lambda x: x != "")


def tidy_records(df: DataFrame, normalise: bool = False) -> DataFrame:
    """Trim every value, drop rows whose values are all blank, clean headers."""
    names = [clean_header(c) for c in df.columns]
    if normalise:
        names = [normalise_name(n) for n in names]
    problems = validate_headers(names)
    if problems:
        raise ValueError("; ".join(problems))
    df = df.toDF(*names)
    df = df.select(*[F.regexp_replace(F.col(f"`{c}`").cast("string"), r"(?U)^\s+|\s+$", "").alias(c) for c in names])
    if names:
        df = df.filter(_any_value(names))
    return df


def file_records(files: DataFrame, encoding: str | None = None, fallback: str = "cp1252") -> DataFrame:
    """``path, problem, row_no, names, values`` of files (``path, content``): a row per record.

    The header's names go with each record; a file whose header fails ``validate_headers``
    gives one row with the ``problem`` and no values. Bytes that the encoding has no
    character for become U+FFFD.
    """
    texts = pa.list_(pa.string())
    columns = [("path", pa.string()), ("problem", pa.string()), ("row_no", pa.int64()), ("names", texts), ("values", texts)]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _csv.field_size_limit(2**31 - 1)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), columns)], schema=pa.schema(columns))

        for b in batches:
            for path, content in zip(b.column("path"), b.column("content")):
                path, raw = path.as_py(), content.as_buffer().to_pybytes() if content.is_valid else b""
                text = io.TextIOWrapper(io.BytesIO(raw), encoding or detect_encoding(raw, fallback), errors="replace", newline="")
                reader = _csv.reader(text)
                names = [clean_header(n) for n in next(reader, [])]
                problems = validate_headers(names)
                if problems or not names:
                    yield out([(path, "; ".join(problems) or None, 0, names, None)])
                    continue
                rows = []
                for i, record in enumerate(reader, 1):
                    values = [*record[: len(names)], *[None] * (len(names) - len(record))]
                    rows.append((path, None, i, names, values))
                    if len(rows) == BATCH:
                        yield out(rows)
                        rows = []
                yield out(rows or [(path, None, 0, names, None)])

    return files.select("path", "content").mapInArrow(parse, "path string, problem string, row_no bigint, names array<string>, values array<string>")


def read_csv_records(spark: SparkSession, path: str, encoding: str | None = None, normalise: bool = False,
                     glob: str | None = None, with_file: bool = False, fallback: str = "cp1252") -> DataFrame:
    """CSV file(s) -> all-string records.

    ``encoding=None`` detects it per file, from the whole file. ``glob='*.csv'`` reads every matching file
    of a folder and those in it (columns matched by name, missing ones NULL) and ``with_file`` keeps the
    source file name. Files are read by the tasks, one task for several small files;
    a file is held whole by its task, as an encoding needs every byte of it (files over 2 GB
    are beyond Spark's binary source). The driver sees the distinct header names and
    what is wrong with headers.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob or "*").option("recursiveFileLookup", True).load(path)
    if files.select("path").isEmpty():
        raise ValueError(f"no file at {path}")
    records = file_records(files, encoding, fallback)
    bad = records.filter(F.col("problem").isNotNull()).select("path", "problem").orderBy("path").first()
    if bad:
        raise ValueError(f"{bad['path']}: {bad['problem']}")
    first = records.filter("row_no <= 1").groupBy("names").agg(F.min("path").alias("path")).orderBy("path").select("names").collect()
    names = list(dict.fromkeys(n for r in first for n in r["names"]))
    rows = records.filter(F.col("values").isNotNull()).withColumn("__m", F.map_from_arrays("names", "values"))
    rows = rows.select(*(["path"] if with_file else []), *[F.col("__m")[n].alias(n) for n in names])
    if not with_file:
        return tidy_records(rows, normalise)
    clean = tidy_records(rows.select(F.col("path").alias("source_file"), *[F.col(f"`{n}`") for n in names]), False)
    clean = clean.filter(_any_value(names))
    return clean.toDF("source_file", *[normalise_name(n) if normalise else n for n in names])
