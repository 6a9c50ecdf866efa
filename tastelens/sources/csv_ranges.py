"""CSV files with quoted line breaks, read by byte ranges.

Whether a line begins inside quotes depends on all quotes before it, which is why such files are
commonly read by one task each. Here the quotes of every range are counted first, a running total
over the ranges tells how each begins, and all ranges are then cut into records at once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastelens.session import cut
from tastelens.sources.files import typed

# Ranges whose counts are sent to every task (one row per 128 MB or so); more are joined by a shuffle.
MOST_RANGES = 200_000

_PIECE = "file string, start bigint, opens boolean, header boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, place, value, quotes): lines with the byte at which their range begins."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).alias("quotes"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """(file, start, lines, inside, returns): lines of every range, whether it begins inside quotes
    and whether the first line of its file ends in a carriage return."""
    counts = cut(
        lines.groupBy("file", "start").agg(
            F.count(F.lit(1)).alias("lines"), F.sum("quotes").alias("quotes"),
            F.min_by(F.col("value").endswith("\r"), "place").alias("returns"),
        )
    )
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    returns = F.first("returns").over(order)
    return cut(counts.select("file", "start", "lines", odd.alias("inside"), returns.alias("returns")))


def _cutter(broken: bool):
    """Task function: whole records of the ranges, or the pieces of those that cross a border."""

    def records(batches):
        at, inside, head, seen, expected, lines = None, False, False, 0, 0, []
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("file", "start", "value", "quotes", "lines", "inside"))
            for file, start, value, quotes, count, carried in zip(*columns):
                if (file, start) != at:
                    if seen != expected or count is None:
                        raise RuntimeError("byte ranges changed between two reads of a file")
                    at, inside, head, seen, expected = (file, start), carried, carried, 0, count
                    header = start == 0
                lines.append(value)
                inside ^= quotes % 2 == 1
                seen += 1
                if not inside or seen == expected:
                    if broken == (head or inside):
                        out.append((file, start, not head, header, "\n".join(lines)))
                    header, head, lines = False, False, []
            names = ("file", "start", "opens", "header", "record")
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
            made = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(m, k) for m, k in zip(made, kinds)], names=names)
        if seen != expected:
            raise RuntimeError("byte ranges changed between two reads of a file")

    return records


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the text of every record but the headers, which are the first of each file.

    Quotes must be doubled inside quoted fields and occur in no others, as CSV writers do. Empty
    lines are left out; in a file whose first line ends in ``\\r\\n`` every ``\\r\\n`` becomes ``\\n``.
    Records that cross a border between ranges are put together from their pieces; a quote that is
    never closed takes in the rest of its file.
    """
    lines = _lines(spark, path)
    ranges = _ranges(lines)
    if ranges.count() <= MOST_RANGES:
        known = lines.join(F.broadcast(ranges), ["file", "start"], "left")
    else:
        known = lines.join(ranges, ["file", "start"], "left")
    # the order of the file, which the wide join loses; sorted input costs next to nothing
    known = known.sortWithinPartitions("file", "start", "place").drop("place")
    bare = F.regexp_replace("value", r"\r\z", "")
    known = known.withColumn("value", F.when(F.col("returns"), bare).otherwise(F.col("value")))
    whole = known.mapInArrow(_cutter(False), _PIECE)
    pieces = cut(known.mapInArrow(_cutter(True), _PIECE))
    order = Window.partitionBy("file").orderBy("start", "opens")
    owner = pieces.select("file", "start", "opens", F.sum(F.col("opens").cast("int")).over(order).alias("n"))
    parts = F.sort_array(F.collect_list(F.struct("start", "opens", "record")))
    joined = (
        pieces.join(owner, ["file", "start", "opens"])
        .groupBy("file", "n")
        .agg(F.max("header").alias("header"), F.array_join(parts["record"], "\n").alias("record"))
    )
    every = whole.select("header", "record").union(joined.select("header", "record"))
    return every.filter(~F.col("header") & (F.col("record") != "")).select("record")


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As ``files.read_csv``, with every file read by as many tasks as it has byte ranges."""
    places = ", ".join(f"c{i} string" for i in range(len(schema.fields)))
    options = {
        "quote": '"', "escape": '"', "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    fields = csv_records(spark, path).select(F.from_csv("record", places, options).alias("r"))
    return fields.select(*(typed(F.col(f"r.c{i}"), f) for i, f in enumerate(schema.fields)))
