"""Units, guards, rounding and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
CFS_DAY_TO_TAF = 0.001983471
SPILL_TO_TAF = 0.0603
MISSING_CODE = -901.0
SHORTAGE_FLOOR = 0.1


def rounded(x: Column, digits: int = 2) -> Column:
    """Rounds half away from zero; a hair is added first, so that sums in another order round alike."""
    return F.round(x + F.when(x < 0, -1e-7).otherwise(1e-7), digits)


def null_if_nan(v: Column) -> Column:
    return F.when(F.isnan(v), F.lit(None)).otherwise(v)


def to_number(text: Column) -> Column:
    """A double; NaN and text that is no number are null."""
    return null_if_nan(text.cast("string").try_cast("double"))


def cfs_to_taf(v: Column, days: Column, unit: Column | None = None) -> Column:
    """Thousand acre-feet in a month from a flow; values whose unit is not CFS stay as they are."""
    taf = v * days * CFS_DAY_TO_TAF
    return taf if unit is None else F.when(F.upper(unit) == "CFS", taf).otherwise(v)


def spill_volume_taf(v: Column) -> Column:
    return v * SPILL_TO_TAF


def pct_of_capacity(v: Column, capacity: Column) -> Column:
    return F.try_divide(v * 100, capacity)


def clip(v: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bounds a value; null stays null."""
    out = v
    if low is not None:
        out = F.when(out < low, F.lit(float(low))).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(float(high))).otherwise(out)
    return out


def ratio_or(v: Column, w: Column, default: float | None) -> Column:
    """v / w where w is positive, else the default."""
    return F.when(w > 0, F.try_divide(v, w)).otherwise(F.lit(default).cast("double"))


def missing_code_to_null(v: Column, code: float = MISSING_CODE) -> Column:
    return null_if_nan(F.nullif(v, F.lit(code)))


def adjusted_timestamp(ts: Column, mode: str = "end_of_month") -> Column:
    """The date of a monthly stamp.

    ``end_of_month``: month ends stay, a first day goes to the month before, others to their month's end.
    """
    day = ts.cast("date")
    if mode == "end_of_month":
        return F.when(F.day(day) == 1, F.date_sub(day, 1)).otherwise(F.last_day(day))
    if mode == "start_of_month":
        return F.trunc(day, "month")
    if mode == "none":
        return day
    raise ValueError("mode must be end_of_month, start_of_month or none")


def wba_id_to_map_id(zone: Column) -> Column:
    """WBA2 is 02, WBA7N is 07N, WBA10 is 10; anything else stays."""
    number = F.regexp_extract(zone, r"^WBA(\d+)([A-Z]*)$", 1)
    return F.when(zone.rlike(r"^WBA\d+[A-Z]*$"), F.concat(F.when(F.length(number) < 2, F.lpad(number, 2, "0")).otherwise(number), F.regexp_extract(zone, r"^WBA(\d+)([A-Z]*)$", 2))).otherwise(zone)


def has_variable_prefix(code: Column) -> Column:
    return code.rlike("^[SC]_")


def strip_variable_prefix(code: Column) -> Column:
    return F.when(has_variable_prefix(code), F.substring(code, 3, 1_000_000)).otherwise(code)


POINT = r"^POINT\s*\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)$"


def point_longitude(wkt: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(wkt), POINT, 1), F.lit("")).try_cast("double")


def point_latitude(wkt: Column) -> Column:
    return F.nullif(F.regexp_extract(F.trim(wkt), POINT, 2), F.lit("")).try_cast("double")


def scenario_from_path(path: Column) -> Column:
    """The id in ``scenario/s0020/…``, else one character and four digits of the name, else the cleaned stem.

    Ids are in lower case; the stem is cut to 12 characters.
    """
    folder = F.nullif(F.regexp_extract(F.lower(path), r"scenario[/=](s\d{4})/", 1), F.lit(""))
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    anywhere = F.nullif(F.lower(F.regexp_extract(base, r"([A-Za-z0-9]\d{4})", 1)), F.lit(""))
    stem = F.regexp_replace(base, r"\.[^.]*$", "")
    safe = F.substring(F.lower(F.regexp_replace(stem, r"[^A-Za-z0-9._-]+", "_")), 1, 12)
    return F.coalesce(folder, anywhere, F.nullif(safe, F.lit("")), F.lit("scenario"))


def int_array(text: Column) -> Column:
    """``{1,3,4}`` as an array of integers; empty text is an empty array."""
    inner = F.regexp_replace(F.trim(text), r"[{}\s]", "")
    return F.when(inner == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(inner, ","), lambda x: x.try_cast("int")))


def map_of(entries: Column) -> Column:
    """A map out of an array of (key, value) structs; of entries with one key the largest stays."""
    last = lambda e: F.filter(e, lambda x, i: F.coalesce(F.get(e, i + 1)["key"] != x["key"], F.lit(True)))
    return F.map_from_entries(F.get(F.transform(F.array(F.array_sort(entries)), last), F.lit(0)))
