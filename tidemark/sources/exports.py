"""Wide model exports to long rows: headers, columns, paths and points.

An export has header rows (a, b, c, e, f, type, units), then a date and one cell for each column. The needed columns
are chosen from the header first, and only their cells are taken out of a line, so ten thousand columns cost nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import ANNUAL_DAYS, is_bare_year, model_date, with_water_calendar
from tidemark.functions.scalars import adjusted_timestamp, missing_code_to_null, scenario_from_path, to_number
from tidemark.sources.shared import row_numbers

LABELS = ("a", "b", "c", "e", "f", "type", "units")
HEADER_SEARCH = 15


def raw_lines(lines: DataFrame) -> DataFrame:
    """Rows (file, block, at, cells) of text lines with their file; ``at`` ascends within a block of a file."""
    return lines.select("file", "block", F.monotonically_increasing_id().alias("at"), F.split("value", ",", -1).alias("cells"))


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    text = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return raw_lines(text)


def first_lines(lines: DataFrame, n: int = HEADER_SEARCH) -> DataFrame:
    """The first ``n`` lines of each file with their number from 0."""
    top = lines.where("block = 0")
    start = top.groupBy("file").agg(F.min("at").alias("_start"))
    return top.join(start, "file").withColumn("line", F.col("at") - F.col("_start")).where(F.col("line") < n).drop("_start")


def is_dated(cells: Column) -> Column:
    return model_date(F.get(cells, F.lit(0))).isNotNull()


def detect_header_rows(lines: DataFrame) -> DataFrame:
    """Rows (file, data_start): 7, or the first line with a date among the first 15 where line 7 has none."""
    return first_lines(lines).groupBy("file").agg(F.coalesce(
        F.max(F.when((F.col("line") == len(LABELS)) & is_dated(F.col("cells")), F.lit(len(LABELS)))),
        F.min(F.when(is_dated(F.col("cells")), F.col("line")))
    ).alias("data_start"))


def series_meta(lines: DataFrame) -> DataFrame:
    """Rows (file, col_idx, a, b, c, e, f, type, units) of the header.

    Header rows are known by the label in their first cell, or by position in files without a labelled row b.
    """
    top = first_lines(lines)
    label = F.lower(F.trim(F.get("cells", F.lit(0))))
    named = top.withColumn("label", label)
    labelled = named.where("label = 'b'").select("file").distinct()
    position = F.get(F.array(*map(F.lit, LABELS)), F.col("line").cast("int"))
    own = named.join(labelled, "file", "left_semi").where(F.col("label").isin(*LABELS)).select("file", "label", "cells")
    placed = top.join(labelled, "file", "left_anti").where(F.col("line") < len(LABELS)).select("file", position.alias("label"), "cells")
    cells = own.unionByName(placed).select("file", "label", F.posexplode("cells").alias("col_idx", "text")).where("col_idx > 0")
    values = [F.max(F.when(F.col("label") == k, F.trim("text"))).alias(k) for k in LABELS]
    return cells.groupBy("file", "col_idx").agg(*values).where("b is not null and b <> ''")


def select_variables(table: DataFrame, wanted: DataFrame, column: str = "b") -> DataFrame:
    """Rows whose trimmed name is wanted (variable), exactly."""
    return table.withColumn(column, F.trim(column)).join(wanted.select(F.col("variable").alias(column)).distinct(), column, "left_semi")


def first_column_wins(meta: DataFrame) -> DataFrame:
    """Of columns with one name in a file, the first."""
    first = meta.groupBy("file", "b").agg(F.min("col_idx").alias("col_idx"))
    return meta.join(first, ["file", "b", "col_idx"], "left_semi")


def select_column_block(meta: DataFrame, start: int, prefix: str) -> DataFrame:
    """Columns from a position on whose name has a prefix."""
    return meta.where((F.col("col_idx") >= start) & F.startswith("b", F.lit(prefix)))


def long_series(lines: DataFrame, meta: DataFrame) -> DataFrame:
    """Rows (file, scenario, variable, ts, value, units, annual) of the chosen columns.

    Lines whose first cell is no date are left out; cells that are no number, and NaN, are null. A file whose dates are
    bare years only is annual: its dates are the ends of water years, and a year outside 1900 to 2100 is an error.
    """
    columns = meta.groupBy("file").agg(F.collect_list(F.struct("col_idx", "b", "units")).alias("_columns"))
    text = F.trim(F.get("cells", F.lit(0)))
    dated = lines.withColumns({"ts": model_date(text), "_bare": is_bare_year(text)}).where("ts is not null or _bare")
    kinds = dated.groupBy("file").agg(F.bool_and("_bare").alias("annual"))
    year = F.try_to_number(F.substring(text, 1, 4), F.lit("9999")).cast("int")
    checked = F.when(year.between(1900, 2100), year).otherwise(F.raise_error(F.concat(F.lit("not a year from 1900 to 2100: "), text)).cast("int"))
    rows = dated.join(columns.join(kinds, "file"), "file").withColumn(
        "ts", F.when(F.col("annual"), F.make_date(checked, F.lit(9), F.lit(30))).otherwise(F.col("ts"))
    ).where("ts is not null")
    cell = F.explode(F.transform("_columns", lambda c: F.struct(c["b"].alias("variable"), F.get(F.col("cells"), c["col_idx"]).alias("text"), c["units"].alias("units"))))
    return rows.select("file", "ts", "annual", cell.alias("c")).select(
        "file", scenario_from_path(F.col("file")).alias("scenario"), "c.variable", "ts", to_number(F.trim("c.text")).alias("value"), "c.units",
        "annual"
    )


def with_series_calendar(series: DataFrame) -> DataFrame:
    """The water calendar of rows with ``ts`` and ``annual``; annual rows have water_month 0 and 365 days."""
    out = with_water_calendar(series)
    return out.withColumns({
        "water_month": F.when(F.col("annual"), F.lit(0)).otherwise(F.col("water_month")),
        "days_in_month": F.when(F.col("annual"), F.lit(ANNUAL_DAYS)).otherwise(F.col("days_in_month"))
    })


def read_dss_csv(spark: SparkSession, paths: str | Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """Long rows of exports: only wanted variables, the first column of a name."""
    lines = read_lines(spark, paths)
    meta = series_meta(lines)
    meta = first_column_wins(meta if wanted is None else select_variables(meta, wanted))
    return long_series(lines, meta)


MOST_PATTERNS = 1000


def pick_first_existing(files: DataFrame, patterns: DataFrame) -> DataFrame:
    """For each scenario the file that fits the pattern of lowest rank; ties by path.

    Every path is held against every pattern, so more than ``MOST_PATTERNS`` of them are an error.
    """
    if patterns.count() > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} patterns")
    return files.join(F.broadcast(patterns), F.expr("path rlike pattern")).groupBy("scenario").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def catalogue_files(files: DataFrame) -> DataFrame:
    """Per scenario which of zip, output csv and sv csv exist; scenarios without any are left out."""
    low = F.lower("path")
    kinds = {"zip": F.endswith(low, F.lit(".zip")), "output_csv": low.rlike(r"output[^/]*\.csv$"), "sv_csv": low.rlike(r"sv[^/]*\.csv$")}
    rows = files.where(~F.endswith("path", F.lit("/"))).withColumn("scenario", scenario_from_path(F.col("path")))
    out = rows.groupBy("scenario").agg(*(F.bool_or(hit).alias(f"has_{k}") for k, hit in kinds.items()))
    return out.where("has_zip or has_output_csv or has_sv_csv")


#: Tokens of file names, the strong one first, and files that are no output.
SV_TOKENS = ("_sv", ("statevar", "input"))
OUTPUT_TOKENS = ("_dv", ("out", "output", "results"))
GROUNDWATER_FILES = ("cvgroundwaterbudget.dss", "cvgroundwaterout.dss")


def classify_dss_paths(paths: DataFrame, sv: tuple[str, Sequence[str]] = SV_TOKENS, output: tuple[str, Sequence[str]] = OUTPUT_TOKENS) -> DataFrame:
    """Per package the input (sv_path) and output file (output_path) from rows (package, position, path).

    Candidates are those in the folders dss/input and dss/output; where a package has neither folder, all files are. A
    strong token goes before a weak one, then the first in order wins; groundwater files are no output.
    """
    slug = F.concat(F.lit("/"), F.lower(F.replace("path", F.lit("\\"), F.lit("/"))), F.lit("/"))
    base = F.lower(F.regexp_extract(F.replace("path", F.lit("\\"), F.lit("/")), r"([^/]*)$", 1))
    rows = paths.withColumns({
        "_in": F.contains(slug, F.lit("/dss/input/")), "_out": F.contains(slug, F.lit("/dss/output/")) & ~base.isin(*GROUNDWATER_FILES), "_base": base
    })
    folders = rows.groupBy("package").agg(F.bool_or(F.col("_in") | F.col("_out")).alias("_folders"))
    rows = rows.join(folders, "package")

    def best(tokens: tuple[str, Sequence[str]], inside: str, barred: Column) -> Column:
        strong, weak = tokens
        rank = F.when(F.contains("_base", F.lit(strong)), 0)
        for token in weak:
            rank = rank.when(F.contains("_base", F.lit(token)), 1)
        candidate = F.when(F.col("_folders"), F.col(inside)).otherwise(F.endswith("_base", F.lit(".dss"))) & ~barred
        key = F.when(candidate & rank.isNotNull(), F.struct(rank.alias("r"), F.col("position").alias("p")))
        return F.min_by("path", key)

    return rows.groupBy("package").agg(best(sv, "_in", F.lit(False)).alias("sv_path"), best(output, "_out", F.col("_base").isin(*GROUNDWATER_FILES)).alias("output_path"))


def parse_pathnames(rows: DataFrame) -> DataFrame:
    """Adds parts a to f of ``/A/B/C/D/E/F/`` and the series key a|b|c|e|f; paths with fewer parts are left out."""
    parts = F.split("pathname", "/", -1)
    out = rows.where(F.size(parts) >= 7).withColumns({k: F.get(parts, F.lit(i)) for i, k in enumerate("abcdef", 1)})
    return out.withColumn("series_key", F.concat_ws("|", "a", "b", "c", "e", "f"))


#: What parts b, f and c look like in model output, and parts a and d in model input.
OUTPUT_LOOKS = {2: "^[SCDI]$", 6: "^(TAF|CFS|AF)$", 3: "^[A-Z0-9_]+$"}
INPUT_LOOKS = {1: "^SV", 4: "^(INITIAL|INPUT|STATE)$"}


def detect_series_type(rows: DataFrame) -> DataFrame:
    """Per file calsim_output or sv_input by a vote over its first 10 pathnames; unknown without any."""
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy("file").orderBy("position"))).where("_n <= 10")
    parts = F.split("pathname", "/", -1)
    part = lambda i: F.get(parts, F.lit(i))
    full = F.size(parts) >= 7
    one = lambda c: F.when(full & c, 1).otherwise(0)
    votes = first.groupBy("file").agg(
        F.sum(sum((one(part(i).rlike(look)) for i, look in OUTPUT_LOOKS.items()), F.lit(0))).alias("o"),
        F.sum(sum((one(part(i).rlike(look)) for i, look in INPUT_LOOKS.items()), F.lit(0))).alias("i"),
    )
    return votes.select("file", F.when(F.col("o") > F.col("i"), "calsim_output").otherwise("sv_input").alias("series_type"))


def merge_series_points(rows: DataFrame) -> DataFrame:
    """Of points of one series and time the last that was read."""
    return rows.groupBy("series_key", "ts").agg(F.max_by("value", "read_order").alias("value"))


def clip_period(series: DataFrame, start: str = "1921-10-31", end: str = "2021-09-30") -> DataFrame:
    """Rows from start to end, both included."""
    return series.where(F.col("ts").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def clean_points(points: DataFrame, mode: str = "end_of_month") -> DataFrame:
    """Decoded points as series: parsed paths, missing codes null, stamps as dates, later reads winning."""
    rows = parse_pathnames(points).withColumns({"value": missing_code_to_null(F.col("value")), "ts": adjusted_timestamp(F.col("ts"), mode)})
    return merge_series_points(rows)


def read_seed(spark: SparkSession, path: str, schema: str, zero: Sequence[str] = ()) -> DataFrame:
    """A dimension CSV with a header and quoted text; blank numbers of the columns in ``zero`` are 0."""
    out = spark.read.csv(path, schema=schema, header=True, quote='"', escape='"', multiLine=True)
    return out.fillna(0, list(zero)) if zero else out


#: Suffix, type, name and description of the kinds of release.
RELEASES = (
    ("", "release_total", "Total Release", "Total release from {name}"),
    ("_NCF", "release_normal", "Normal Release", "Normal controlled release from {name} (≤ release capacity)"),
    ("_FLOOD", "release_flood", "Flood Spill", "Flood spill from {name} (above release capacity)"),
)
FIRST_RELEASE_ID = 196


def expand_entity_variables(entities: DataFrame) -> DataFrame:
    """Every entity (id, short_code, name) times the kinds of release, with running ids from 196 in id order."""
    fields = ("suffix", "variable_type", "label", "about")
    kinds = F.array(*(F.struct(F.lit(i).alias("n"), *(F.lit(v).alias(f) for f, v in zip(fields, kind, strict=True))) for i, kind in enumerate(RELEASES)))
    rows = row_numbers(entities, ["id"], "rank").select("*", F.explode(kinds).alias("k"))
    return rows.select(
        ((F.col("rank") - 1) * len(RELEASES) + F.col("k.n") + FIRST_RELEASE_ID).alias("variable_id"), F.concat(F.lit("C_"), "short_code", "k.suffix").alias("calsim_id"),
        F.concat("name", F.lit(" "), "k.label").alias("variable_name"), F.replace("k.about", F.lit("{name}"), "name").alias("description"), F.col("id").alias("entity_id"), "k.variable_type",
    )
