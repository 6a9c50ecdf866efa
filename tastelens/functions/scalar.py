"""Column expressions on numbers, dates and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastelens import fixed_values as fv


def half_even(value: Column, digits: int) -> Column:
    """Round half to even; adding 0.0 turns a negative zero into a plain one."""
    return F.bround(value, digits) + F.lit(0.0)


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Quotient, or 0 where the denominator is 0 or missing or the quotient is no finite number."""
    found = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.when(F.abs(found) < F.lit(float("inf")), found).otherwise(F.lit(0.0))


def to_number(value: Column) -> Column:
    """Number read from any scalar; unreadable or missing becomes 0.

    Type suffixes and hexadecimal digits, which the cast would take, are no numbers.
    """
    foreign = value.cast("string").rlike(r"(?i)x|(?<!in)[df]\s*$")
    read = F.when(~foreign, value.try_cast("double"))
    return F.coalesce(F.nanvl(read, F.lit(0.0)), F.lit(0.0))


def log_count(value: Column) -> Column:
    return F.log1p(to_number(value))


def equals_or_false(value: Column, wanted) -> Column:
    return F.coalesce(value == F.lit(wanted), F.lit(False))


def rating_class(rating: Column) -> Column:
    """Ordered class of a 0..5 rating; null outside the range."""
    low, middle, high = fv.RATING_CLASSES
    return (
        F.when(rating.between(0, 2), low)
        .when((rating > 2) & (rating <= 3), middle)
        .when((rating > 3) & (rating <= 5), high)
    )


def class_code(label: Column, classes: Sequence[str] = fv.RATING_CLASSES) -> Column:
    """Position of the label in its ordered classes, -1 for none."""
    position = F.array_position(F.lit(list(classes)), label)
    return (F.coalesce(position, F.lit(0)) - 1).cast("int")


def five_star(rating: Column) -> Column:
    return F.coalesce((rating == 5).cast("int"), F.lit(0))


def relabel(value: Column, labels: Mapping) -> Column:
    """Replace known values; anything else passes through."""
    result = value
    for old, new in labels.items():
        result = F.when(value == F.lit(old), F.lit(new)).otherwise(result)
    return result


def capitalise(value: Column) -> Column:
    return F.concat(F.upper(F.left(value, F.lit(1))), F.lower(F.substr(value, F.lit(2))))


def parse_date(value: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Timestamp in the given format; text that does not fit it becomes null."""
    return F.try_to_timestamp(value, F.lit(fmt))


def year_of(value: Column) -> Column:
    return F.year(value).cast("bigint")


def month_of(value: Column) -> Column:
    return F.month(value).cast("bigint")


def entity_id(link: Column, pattern: str = fv.ENTITY_ID_PATTERN) -> Column:
    """Numeric id inside a link, null when there is none."""
    return F.nullif(F.regexp_extract(link, pattern, 1), F.lit("")).try_cast("bigint")


def first_present(*values: Column) -> Column:
    """First value that is neither null, empty nor zero."""
    present = [F.when(~v.cast("string").isin("", "0"), v) for v in values[:-1]]
    return F.coalesce(*present, values[-1])


def boolean_label(value: Column) -> Column:
    """A flag as a category: True, False or nan for missing."""
    return F.coalesce(F.initcap(value.cast("string")), F.lit("nan"))
