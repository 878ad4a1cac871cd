"""File sources and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from acreage.constants import HEADER_ROW_CANDIDATES
from acreage.functions.scalar import nulls_for_nan, zipcode
from acreage.operators.joins import lookup_join
from acreage.schemas import LISTING_TYPES
from acreage.session import stage


def read_csv_typed(
    spark: SparkSession, path: str, types: dict[str, T.DataType], position: str | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with a header; names are trimmed and upper-cased, known columns get their type.

    Everything is read as text, so no inference pass runs and zip codes keep leading zeros. A
    value that does not fit its type becomes null. `position` names a column with the place of the
    row in its file, an order for exports that have no key. Quoted cells may hold line breaks; a file
    known to have none can be read by many tasks with `multi_line=False`.
    """
    raw = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line).csv(path)
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    placed = raw.select("*", place.alias(position)) if position else raw
    named = placed.toDF(*[c.strip().upper() for c in raw.columns], *([position] if position else []))
    typed = {c: F.col(f"`{c}`").try_cast(types[c]) for c in named.columns if c in types}
    return nulls_for_nan(named.withColumns(typed))


def load_raw(spark: SparkSession, path: str, position: str | None = None, multi_line: bool = True) -> DataFrame:
    return read_csv_typed(spark, path, LISTING_TYPES, position, multi_line)


def load_geocode(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_typed(spark, path, LISTING_TYPES)


def load_cleaned(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """Cleaned listings, with five-digit zip codes."""
    df = load_raw(spark, path, position)
    return df.withColumn("ZIPCODE", zipcode(F.col("ZIPCODE"))) if "ZIPCODE" in df.columns else df


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns; what a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _cells(line) -> Column:
    """Trimmed, unquoted, upper-case cells of a header line."""
    return F.transform(F.split(line, ","), lambda c: F.upper(F.regexp_replace(c, r'^[\s"]+|[\s"]+$', "")))


def _lines(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Every line of every file with a number that grows along the file.

    A task numbers the lines it reads in order, so the numbers of a file's first block are consecutive."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") == 0).alias("opening"),
        F.monotonically_increasing_id().alias("number"), F.regexp_replace("value", r"\r$", "").alias("line"))


def locate_header_rows(
    spark: SparkSession, paths: list[str] | str, column: str = "SALE PRICE",
    candidates: tuple[int, ...] = HEADER_ROW_CANDIDATES,
) -> DataFrame:
    """`(file, header_row)` for CSV exports with a preamble; null where no candidate row names `column`.

    Only the candidate lines of each file are compared, in order of preference.
    """
    return _headers(_lines(spark, paths), column, candidates).select("file", "header_row")


def _headers(lines: DataFrame, column: str, candidates: tuple[int, ...]) -> DataFrame:
    """Per file its first line number, its header row and the header line; an empty file has no row."""
    opening = lines.filter("opening")
    # numbers grow along a file, so its first ones need no sort of the file
    begins = opening.groupBy("file").agg(F.min("number").alias("first"))
    near = lookup_join(opening, begins, ["file"], "inner").filter(F.col("number") - F.col("first") <= max(candidates))
    preference = F.array_position(F.array(*[F.lit(c).cast("long") for c in candidates]), F.col("number") - F.col("first"))
    fits = F.when((preference > 0) & F.array_contains(_cells(F.col("line")), column.upper()),
                  F.struct(preference.alias("order"), (F.col("number") - F.col("first")).cast("int").alias("row"), "line"))
    best = near.groupBy("file", "first").agg(F.min(fits).alias("best"))
    return best.select("file", "first", F.col("best.row").alias("header_row"), F.col("best.line").alias("header"))


def read_exports(
    spark: SparkSession, paths: list[str], column: str = "SALE PRICE", multi_line: bool = False,
    candidates: tuple[int, ...] = HEADER_ROW_CANDIDATES,
) -> DataFrame:
    """Concatenate CSV exports whose header row is found per file; a file without one is an error.

    Lines up to a file's header are left out by their place, whatever they say, and so are empty lines; all
    files are read in one plan under the union of their headers. With `multi_line`, for
    quoted line breaks, a file is read by one task.
    """
    headers = stage(_headers(_lines(spark, paths), column, candidates), "headers")
    missing = sorted(r["file"] for r in headers.filter("header_row IS NULL").select("file").collect())
    if missing:
        raise ValueError(f"no {column!r} header in {missing}")
    # distinct headers are the versions of the export, a handful
    known = [r["header"] for r in headers.select("header").distinct().orderBy("header").collect()]
    names = {h: [c.strip().strip('"').strip() for c in h.split(",")] for h in known}
    width = max(map(len, names.values()), default=0)
    generic = ", ".join(f"c{i} STRING" for i in range(width))
    if multi_line:
        rows = _records(spark, paths, generic, column, headers, candidates)
    else:
        lines = lookup_join(_lines(spark, paths), headers.select("file", "first", "header_row", "header"), ["file"], "inner")
        body = lines.filter(~F.col("opening") | (F.col("number") > F.col("first") + F.col("header_row"))).filter(F.trim("line") != "")
        rows = body.select("header", F.from_csv("line", generic, {"quote": '"', "escape": '"'}).alias("r")).select("header", "r.*")
    union = list(dict.fromkeys(n for h in known for n in names[h]))
    return rows.select(*[
        F.coalesce(*[F.when(F.col("header") == h, F.col(f"c{names[h].index(n)}")) for h in known if n in names[h]]).alias(n) for n in union])


def _records(spark: SparkSession, paths: list[str], generic: str, column: str, headers: DataFrame, candidates: tuple[int, ...]) -> DataFrame:
    """Rows below the header of each file, where cells may hold line breaks."""
    records = spark.read.schema(generic).options(multiLine=True, quote='"', escape='"').csv(paths).select(
        "*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("number"))
    joined = lookup_join(records, headers.select("file", "header_row", "header"), ["file"], "inner")
    cells = [c for c in records.columns if c not in ("file", "number")]
    named = F.array_contains(F.array(*[F.upper(F.trim(c)) for c in cells]), column.upper())
    begins = records.groupBy("file").agg(F.min("number").alias("first"))
    # empty lines of a preamble are no records, so the header is the first of the opening records that names the column
    opening = lookup_join(joined, begins, ["file"], "inner").filter((F.col("number") - F.col("first") <= max(candidates)) & named)
    place = opening.groupBy("file").agg(F.min("number").alias("header_number"))
    return lookup_join(joined, place, ["file"], "inner").filter("number > header_number").select("header", *cells)


def file_manifest(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Name, size and SHA-256 of every file."""
    return spark.read.format("binaryFile").load(paths).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), "path",
        F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"),
    )


def save_baseline(stats: DataFrame, path: str, fmt: str = "parquet") -> None:
    stats.write.mode("overwrite").format(fmt).save(path)


def load_baseline(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "json":
        reader = reader.schema(
            "feature string, mean double, std double, min double, max double, "
            "p25 double, p50 double, p75 double, count long"
        )
    return reader.load(path)


def write_report(report: DataFrame, path: str) -> None:
    """A run report, one nested row, as JSON."""
    report.write.mode("overwrite").json(path)


def log_metrics(
    spark: SparkSession, path: str, run: str, model: str, metrics: dict[str, float], parameters: dict[str, object] | None = None,
) -> None:
    """Append one row `(run, model, kind, name, value, text)` per metric and parameter.

    A parameter is kept as text, and as a value too if it is a number."""
    rows = [(run, model, "metric", name, float(value), None) for name, value in metrics.items() if value is not None]
    for name, value in (parameters or {}).items():
        number = float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else None
        rows.append((run, model, "parameter", name, number, str(value)))
    schema = "run string, model string, kind string, name string, value double, text string"
    spark.createDataFrame(rows, schema).write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
