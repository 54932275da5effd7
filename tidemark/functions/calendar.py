"""Water-year calendar and model dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Formats of dates in exports, tried in order; the time of day is dropped first.
DATE_FORMATS = ("yyyy-MM-dd", "ddMMMyyyy", "M/d/yyyy")
ANNUAL_DAYS = 365


def water_month(ts: Column) -> Column:
    """October is 1, September 12."""
    return (F.pmod(F.month(ts) - 10, F.lit(12)) + 1).cast("int")


def water_year(ts: Column) -> Column:
    return F.year(ts) + F.when(F.month(ts) >= 10, 1).otherwise(0)


def with_water_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds calendar_month, calendar_year, days_in_month, water_month and water_year."""
    t = F.col(ts)
    return df.withColumns({"calendar_month": F.month(t), "calendar_year": F.year(t), "days_in_month": F.day(F.last_day(t)), "water_month": water_month(t), "water_year": water_year(t)})


def model_date(text: Column) -> Column:
    """A date out of ISO text or a ``31OCT1921 2400`` stamp; a bare year is its first day; anything else null.

    A stamp of 2400 hours is the end of its own day, so the day stands.
    """
    day = F.initcap(F.regexp_extract(F.trim(text), r"^(\S+)", 1))
    iso = F.regexp_extract(day, r"^(\d{4}-\d{2}-\d{2})", 1)
    stamp = F.regexp_replace(day, r"^(\d{1,2})([A-Za-z]{3})(\d{4})$", "$1-$2-$3")
    return F.coalesce(
        F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")),
        F.try_to_timestamp(F.concat(F.regexp_replace(stamp, r"^(\d)-", "0$1-")), F.lit("dd-MMM-yyyy")),
        F.try_to_timestamp(day, F.lit("M/d/yyyy")),
        F.try_to_timestamp(F.regexp_extract(day, r"^((?:19|20)\d{2}|1900|2100)$", 1), F.lit("yyyy")),
    ).cast("date")


def is_bare_year(text: Column) -> Column:
    return F.trim(text).rlike(r"^\d{4}(\.0)?$")


def with_model_calendar(df: DataFrame, date_text: str, file: str) -> DataFrame:
    """Adds ts, water_month, water_year and days_in_month from date text; a file of bare years only is annual.

    Annual rows have water_month 0 and 365 days. A bare year outside 1900 to 2100 in an annual file is an error.
    """
    raw = F.trim(F.col(date_text))
    annual = df.groupBy(F.col(file).alias("_file")).agg(F.bool_and(is_bare_year(raw)).alias("_annual"))
    year = F.try_to_number(F.regexp_extract(raw, r"^(\d{4})", 1), F.lit("9999")).cast("int")
    checked = F.when(year.between(1900, 2100), year).otherwise(F.raise_error(F.concat(F.lit("not a year from 1900 to 2100: "), raw)).cast("int"))
    joined = df.join(annual, df[file] == annual["_file"], "left")
    yearly = F.col("_annual")
    ts = F.when(yearly, F.make_date(checked, F.lit(9), F.lit(30))).otherwise(model_date(raw))
    out = joined.withColumn("ts", ts)
    return out.withColumns({
        "water_month": F.when(yearly, F.lit(0)).otherwise(water_month(F.col("ts"))),
        "water_year": F.when(yearly, F.year("ts")).otherwise(water_year(F.col("ts"))),
        "days_in_month": F.when(yearly, F.lit(ANNUAL_DAYS)).otherwise(F.day(F.last_day("ts"))),
    }).drop("_file", "_annual")
