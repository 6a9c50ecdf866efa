"""CSV, JSON, Markdown and Parquet in and out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from tastelens import fixed_values as fv
from tastelens import schemas
from tastelens.functions.scalar import entity_id, first_present

ORIGIN = ("page_file", "page_split", "page_no", "position")
BYTE_ORDER_MARK = "\ufeff"


# --- CSV -------------------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed CSV scan: header, quoted line breaks, usual null spellings, bad values to null.

    Quoted line breaks keep a file from being split, so many files give the parallelism;
    ``csv_ranges.read_csv_ranges`` splits the files themselves.
    """
    as_text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(as_text)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return raw.select(*(typed(F.col(f"`{f.name}`"), f) for f in schema.fields))


def typed(text: Column, field: StructField) -> Column:
    """A CSV field in its type; null spellings and values that do not fit become null."""
    present = F.when(~text.isin(list(fv.CSV_NULL_TOKENS)), text)
    if not isinstance(field.dataType, StringType):
        present = present.try_cast(field.dataType)
    return present.alias(field.name)


def write_csv(df: DataFrame, path: str, byte_order_mark: bool = False) -> None:
    """CSV with header and doubled quotes; optionally with a byte order mark before the header."""
    if byte_order_mark:
        df = df.withColumnRenamed(df.columns[0], BYTE_ORDER_MARK + df.columns[0])
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


# --- JSON ------------------------------------------------------------------------------------


def read_result_pages(
    spark: SparkSession, path: str, item: StructType, carry: Mapping[str, DataType] | None = None
) -> DataFrame:
    """Landed result pages (JSON lines), one row per entry of ``results``.

    A page without results gives no row. ``carry`` names page fields to keep. Each entry knows
    where it came from, in the columns of ``ORIGIN``: file, split of the file, page within the
    split (ids grow along a split), place in the page.
    """
    kept = [StructField(name, kind) for name, kind in (carry or {}).items()]
    page = StructType([*kept, StructField("results", ArrayType(item))])
    pages = spark.read.schema(page).json(path).select(
        *(f.name for f in page.fields),
        F.col("_metadata.file_path").alias("page_file"),
        F.col("_metadata.file_block_start").alias("page_split"),
        F.monotonically_increasing_id().alias("page_no"),
    )
    return pages.select(
        *(f.name for f in kept), *ORIGIN[:-1], F.posexplode("results").alias("position", "item")
    )


def explode_results(pages: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return pages.select(*carry, F.explode("results").alias("item"))


def _origin(items: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in items.columns]


def parse_json(text: Column, schema: StructType) -> Column:
    """Typed record from JSON text; a sub-object of the wrong kind becomes null."""
    return F.from_json(text, schema)


def flatten_restaurants(items: DataFrame, item: str = "item") -> DataFrame:
    """Nested restaurant records to the 22 flat columns."""

    def at(path: str) -> Column:
        return F.col(f"{item}.{path}")

    nested = {
        fv.PLACE_ID: first_present(
            at(fv.PLACE_ID), entity_id(at("link"))
        ),
        "reviews_count": at("reviews"),
        "parent_location_id": at(f"parent_location.{fv.PLACE_ID}"),
        "parent_location_name": at("parent_location.name"),
        **{c: at(f"address.{c}") for c in
           ("address", "city", "postal_code", "country", "country_code")},
        **{c: at(f"coordinates.{c}") for c in ("latitude", "longitude")},
    }
    return items.select(
        *((nested[c] if c in nested else at(c)).alias(c)
          for c in schemas.RESTAURANTS.fieldNames()),
        *_origin(items),
    )


def flatten_reviews(items: DataFrame, item: str = "item") -> DataFrame:
    """Nested review records plus the keys of their restaurant to the 21 flat columns.

    ``items`` carries ``restaurant_entity_id``, ``restaurant_name`` and ``restaurant_link``.
    """

    def at(path: str) -> Column:
        return F.col(f"{item}.{path}")

    nested = {
        "restaurant_entity_id": F.col("restaurant_entity_id"),
        "restaurant_name": F.col("restaurant_name"),
        "restaurant_link": F.col("restaurant_link"),
        "trip_type": at("trip.trip_type"),
        "stay_date": at("trip.stay_date"),
        "reviewer_id": at("reviewer.reviewer_id"),
        "reviewer_name": at("reviewer.name"),
        "reviewer_username": at("reviewer.username"),
        "reviewer_profile_link": at("reviewer.profile_link"),
        "reviewer_contribution_count": at("reviewer.contribution_count"),
        "reviewer_hometown": at("reviewer.hometown.location_name_detailed"),
    }
    return items.select(
        *(
            (nested[f.name] if f.name in nested else at(f.name)).cast(f.dataType).alias(f.name)
            for f in schemas.REVIEWS.fields
        ),
        *_origin(items),
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


# --- Markdown ----------------------------------------------------------------------------------


def markdown_rows(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """One table line per row."""
    names = list(columns or df.columns)
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in names]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def markdown_table(
    df: DataFrame, order_by: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """Report table as (line_no, line): header, rule, then the rows in the given order.

    Meant for report tables, whose rows are groups; numbering them is one small window.
    """
    names = list(columns or df.columns)
    spark = df.sparkSession
    head = ["| " + " | ".join(names) + " |", "| " + " | ".join(["---"] * len(names)) + " |"]
    top = spark.range(2).select(
        (F.col("id") + 1).alias("line_no"),
        F.element_at(F.lit(head), (F.col("id") + 1).cast("int")).alias("line"),
    )
    body = df.select(
        (F.row_number().over(Window.orderBy(*order_by)) + 2).cast("bigint").alias("line_no"),
        markdown_rows(df, names).alias("line"),
    )
    return top.unionByName(body)


def write_markdown(sections: DataFrame, path: str) -> None:
    """Text files whose names sort in line order."""
    sections.orderBy("section_no", "line_no").select("line").write.mode("overwrite").text(path)
