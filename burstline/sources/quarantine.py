"""A labelled CSV in one pass with two outputs: rows that are kept, and lines that are refused.

Lines are scanned once, judged, and written once, split by the verdict. A refused line keeps its
text, its file and the reason. What was read, kept and refused is counted while writing and has to
add up.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from burstline.functions.coerce import csv_field_count, has_unclosed_quote, is_bad_label
from burstline.sources.csv_rows import ROW_KEY, resolved

# Reasons, in the order in which they are asked.
UNCLOSED, SHORT, LABEL = "unclosed quote", "too few fields", "unreadable label"
LINE, FILE, REASON = "raw_line", "file", "reason"
_REFUSED = "refused"
# Separates nothing: a line is one field. A line that holds it fails the scan.
_NOWHERE = "\u0001\u0002\u0001"
_OPTIONS = {"escape": '"', "mode": "PERMISSIVE"}


@dataclass(frozen=True)
class Split:
    """``kept``: the columns as text and ``row_key``; ``refused``: ``raw_line``, ``file`` and
    ``reason``; and how many lines there were of each."""

    kept: DataFrame
    refused: DataFrame
    n_lines: int
    n_kept: int
    n_refused: int


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """All lines below the header of each file, blank ones left out."""
    reader = spark.read.schema(StructType([StructField(LINE, StringType())])).options(
        header=True, sep=_NOWHERE, quote="", mode="FAILFAST", enforceSchema=True
    )
    return reader.csv(files).select(LINE, F.col("_metadata.file_path").alias(FILE))


def _reason(header: Sequence[str]) -> Column:
    line = F.col(LINE)
    found = F.when(has_unclosed_quote(line), UNCLOSED).when(
        csv_field_count(line) < len(header), SHORT
    )
    if "Class" in header:
        found = found.when(is_bad_label(F.col("fields.Class")), LABEL)
    return found


def split_rows(
    spark: SparkSession, path: str, out: str, columns: Sequence[str] | None = None
) -> Split:
    """Reads the files below ``path`` by their own headers and writes both outputs to ``out``,
    a folder that must not exist yet.

    Refused are lines with a quote that is not closed, with fewer fields than the header of their
    file, or with a label that is no number. Kept rows are those of ``read_csv_rows`` without
    unreadable labels. ``columns`` as there.
    """
    names, found = resolved(spark, path, columns)
    parts = []
    for header, files in found.items():
        schema = ", ".join("`" + name.replace("`", "``") + "` string" for name in header)
        parsed = F.from_csv(F.col(LINE), schema, _OPTIONS)
        fields = [
            F.col(f"fields.`{n}`") if n in header else F.lit(None).cast("string") for n in names
        ]
        judged = _lines(spark, files).withColumn("fields", parsed).withColumn(
            REASON, _reason(header)
        )
        good = F.col(REASON).isNull()
        parts.append(
            judged.select(
                F.struct(*(f.alias(n) for f, n in zip(fields, names))).alias("fields"),
                F.when(~good, F.col(LINE)).alias(LINE),
                F.when(~good, F.col(FILE)).alias(FILE),
                REASON,
                (~good).alias(_REFUSED),
            )
        )
    if not parts:
        raise ValueError(f"no file below {path} has a header")
    counted = Observation("csv_lines")
    rows = reduce(DataFrame.union, parts).withColumn(ROW_KEY, F.monotonically_increasing_id())
    rows = rows.withColumn("fields", F.when(~F.col(_REFUSED), F.col("fields"))).observe(
        counted,
        F.count("*").alias("lines"),
        F.count_if(~F.col(_REFUSED)).alias("kept"),
        F.count_if(F.col(_REFUSED)).alias("refused"),
    )
    rows.write.partitionBy(_REFUSED).mode("errorifexists").parquet(out)
    totals = counted.get
    written = spark.read.schema(rows.schema).parquet(out)
    kept = written.filter(~F.col(_REFUSED)).select(
        *(F.col(f"fields.`{n}`").alias(n) for n in names), ROW_KEY
    )
    refused = written.filter(F.col(_REFUSED)).select(LINE, FILE, REASON)
    if totals["kept"] + totals["refused"] != totals["lines"]:
        raise ArithmeticError(f"lines do not add up: {totals}")
    return Split(kept, refused, totals["lines"], totals["kept"], totals["refused"])

