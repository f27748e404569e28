"""Scalar expressions. All run in generated JVM code and none fails on bad text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

YEAR_IN_FILE_NAME = r"_(\d{4})\.csv(/|$)"

# A failed try_cast of text costs an exception, some twenty microseconds. So the casts below are
# chosen to succeed for every number in the data and to fail only for what is not one.


def to_id(value: Column) -> Column:
    """Id as bigint; `7.0`, which a float round trip leaves behind, is 7."""
    text = value.cast("string")
    whole = F.when(F.contains(text, F.lit(".")), F.regexp_replace(text, r"\.0*$", ""))
    return whole.otherwise(text).try_cast("bigint")


def to_int(value: Column) -> Column:
    """Number as int without its fraction, also from `5.0`; NULL for anything else."""
    return value.try_cast("double").try_cast("int")


def parse_yyyymmdd(value: Column) -> Column:
    """Date from `19810808` or `19810808.0`; NULL for text and impossible dates."""
    return F.try_to_date(to_int(value).cast("string"), "yyyyMMdd")


def year_from_path(path: Column) -> Column:
    """Year in `..._2003.csv`, for a file or for the folder that Spark writes."""
    return F.nullif(F.regexp_extract(path, YEAR_IN_FILE_NAME, 1), F.lit("")).cast("int")


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def prefer_canonical(name: Column, canonical: Column) -> Column:
    """The canonical spelling where both are known, else the name as it is."""
    return F.when(name != canonical, canonical).otherwise(name)


def percentage(part: Column, whole: Column) -> Column:
    """`part / whole` in percent, two decimals; NULL when the whole is zero or unknown."""
    return F.round(F.try_divide(part, whole) * 100, 2)


def mean_of_percentages(a: Column, b: Column) -> Column:
    """Mean of two two-decimal figures, in decimals so that half a cent rounds up."""
    exact = a.cast("decimal(18,2)") + b.cast("decimal(18,2)")
    return F.round(exact / 2, 2).cast("double")


def zero_to_null(count: Column) -> Column:
    """A count of zero as NULL, which is what a left join to an absent group gives."""
    return F.nullif(count, F.lit(0))
