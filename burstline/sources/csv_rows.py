"""Header-led CSV scan that keeps rows by field count, not by parser verdict.

Every file is read by its own header. Files with the same header are one scan, so there are as
many scans as layouts, and fields go by name from then on.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from burstline.functions.coerce import csv_field_count, has_unclosed_quote

_RAW_LINE = "_raw_line"
ROW_KEY = "row_key"
_FILES_AT_ONCE = 16


def _header_of(spark: SparkSession, file: str) -> tuple[str, ...]:
    """The names in the first line of a file that is not blank; none for an empty file."""
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    path = hadoop.fs.Path(file)
    stream = path.getFileSystem(conf).open(path)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    reader = hadoop.util.LineReader(stream if codec is None else codec.createInputStream(stream))
    try:
        line = hadoop.io.Text()
        while reader.readLine(line) > 0:
            text = line.toString()
            if text.strip():
                return tuple(next(csv.reader([text])))
        return ()
    finally:
        reader.close()


def layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by their header. The driver reads one line of each, some at a
    time. Files without a line have no layout."""
    listed = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    files = sorted(map(unquote, listed))
    with ThreadPoolExecutor(_FILES_AT_ONCE) as pool:
        headers = pool.map(lambda file: _header_of(spark, file), files)
        found: dict[tuple[str, ...], list[str]] = {}
        for file, header in zip(files, headers):
            if header:
                found.setdefault(header, []).append(file)
    for header, files in found.items():
        if len(set(header)) < len(header):
            raise ValueError(f"{files[0]} names a column twice")
    return found


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """All column names of the files, in the order in which they come up."""
    return list(dict.fromkeys(name for header in layouts(spark, path) for name in header))


def resolved(
    spark: SparkSession, path: str, columns: Sequence[str] | None
) -> tuple[list[str], dict[tuple[str, ...], list[str]]]:
    """The columns to give and the files by layout. A file with a column that is not among the
    given ones fails."""
    found = layouts(spark, path)
    names = list(dict.fromkeys(name for header in found for name in header))
    if columns is None:
        return names, found
    for header, files in found.items():
        unknown = [name for name in header if name not in columns]
        if unknown:
            raise ValueError(f"{files[0]} has unknown columns: {', '.join(unknown)}")
    return list(columns), found


def read_csv_rows(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """All fields as text plus ``row_key``, a number unique within the scan.

    Rows with fewer fields than the header of their file are dropped. Longer rows are kept
    without their surplus. The parser marks both as corrupt, so the raw line is counted for
    those rows only. A column that a file does not have is NULL there; ``columns`` names all
    that there may be, and a file with another one fails. Quoted fields that hold line breaks
    need ``multi_line``, which makes a file unsplittable; leave it off for large files. With it
    off, a line with an unclosed quote fails the scan; the lines are read a second time for that.

    ``row_key`` comes from split number and position, so a retried task gives the same
    keys. They change if the files or the split size change.
    """
    names, found = resolved(spark, path, columns)
    scans = []
    for header, files in found.items():
        rows = _read_layout(spark, files, header, multi_line)
        nothing = F.lit(None).cast("string")
        scans.append(
            rows.select(
                *(F.col(f"`{n}`") if n in header else nothing.alias(n) for n in names)
            )
        )
    if not scans:
        schema = StructType([StructField(name, StringType()) for name in names])
        scans = [spark.createDataFrame([], schema)]
    return reduce(DataFrame.union, scans).withColumn(ROW_KEY, F.monotonically_increasing_id())


def _read_layout(
    spark: SparkSession, files: list[str], names: Sequence[str], multi_line: bool
) -> DataFrame:
    schema = StructType([StructField(name, StringType()) for name in [*names, _RAW_LINE]])
    rows = (
        spark.read.schema(schema)
        .options(
            header=True,
            escape='"',
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=_RAW_LINE,
            multiLine=multi_line,
            # Fields are counted by the parser only if it splits whole lines.
            columnPruning=False,
        )
        .csv(files)
    )
    raw_line = F.col(_RAW_LINE)
    complete = raw_line.isNull() | (csv_field_count(raw_line) >= len(names))
    # Spark refuses a scan that reads nothing but the raw line, as ``count`` would make
    # it; this is always true and names a field.
    names_a_field = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    kept = rows.filter(complete & names_a_field).select(*(f"`{name}`" for name in names))
    if multi_line:
        return kept
    refused = F.raise_error(F.lit("a line with an unclosed quote: read with multi_line"))
    cut = spark.read.text(files).filter(
        F.when(has_unclosed_quote(F.col("value")), refused.cast("boolean")).otherwise(False)
    )
    nothing = [F.lit(None).cast("string").alias(name) for name in names]
    return kept.union(cut.select(*nothing))
