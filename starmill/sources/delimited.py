"""Delimited files, read as text and cleaned by the caller's expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.scratch import written

# The texts that a delivered file uses for "no value".
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

SOURCE_PATH = "source_path"
# Of rows that do not fit their header: what is wrong, and the line as it stands.
REASON, LINE = "reject_reason", "reject_line"
SURPLUS, SHORT = "surplus fields", "missing fields"
FILE_SIZE, FILE_TIME = "file_size", "file_time"


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job runs when a source lacks a column."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"source lacks columns {absent}; it has {df.columns}")
    return df


def period_of_path(path: Column) -> Column:
    """Four-digit period at the end of a file name, or of its delivery folder.

    Matches ``.../estimate_2024.csv`` and ``.../estimate_2024/part-0.csv`` alike, so
    one job reads the deliveries of all periods.
    """
    return F.regexp_extract(path, r"_(\d{4})(?:\.[^/]*)?(?:/[^/]*)?$", 1).try_cast("int")


def delivery_name(path: Column) -> Column:
    """Delivery a row came from, as a full path: its folder when Spark wrote part files,
    else its file. Loads replace whole deliveries by this name, so files of one name in
    two folders are two deliveries. A path without scheme and part file is that already."""
    plain = F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:(?://)?", "")
    named = path.startswith("/") & ~path.contains("/part-")
    return F.when(named, path).otherwise(F.regexp_replace(plain, "/part-[^/]*$", ""))


def delivery_names(files: Iterable[str]) -> set[str]:
    """The deliveries that a listing of files holds, named as by ``delivery_name``.

    Taken from the listing, they include those without a single row.
    """
    plain = (re.sub("^[a-zA-Z][a-zA-Z0-9+.-]*:(?://)?", "", unquote(f)) for f in files)
    return {re.sub("/part-[^/]*$", "", f) for f in plain}


def _present(value: Column) -> Column:
    return F.when(~value.isin(MISSING_TEXTS), value)


_BLOCK, _PLACE, _HEADER, _NAMES, _CELLS = "__block", "__place", "__header", "__names", "__cells"
_BROADCAST_FILES = 200_000
_QUOTED = r'"(?:[^"]|"")*"'


def read_lines(reader, paths, encoding: str = "UTF-8") -> DataFrame:
    """Lines of files with their file and block, from ``spark.read`` or ``spark.readStream``."""
    source = reader.option("recursiveFileLookup", "true").text(paths)
    value = F.col("value")
    if encoding.upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        value = F.decode(value.cast("binary"), encoding)
    return source.select(
        value.alias("line"),
        F.col("_metadata.file_path").alias(SOURCE_PATH),
        F.col("_metadata.file_block_start").alias(_BLOCK),
        F.col("_metadata.file_size").alias(FILE_SIZE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
    )


def delivered_files(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """Files under the paths, those without a row included."""
    return spark.read.option("recursiveFileLookup", "true").text(paths).inputFiles()


def _cells(line: Column, sep: str, width: int) -> Column:
    """Fields of a line. One without a quote is split; else Spark's own parser parts it, a
    doubled quote standing for one."""
    fields = [f"c{i}" for i in range(width)]
    parsed = F.from_csv(line, ", ".join(f"{f} string" for f in fields), {"sep": sep, "escape": '"'})
    # Parsed once, not once per field.
    quoted = F.transform(F.array(parsed), lambda row: F.array(*[row[f] for f in fields]))[0]
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, re.escape(sep)))


def _count_cells(line: Column, sep: str) -> Column:
    """Number of fields, separators within quotes aside."""
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, _QUOTED, "")).otherwise(line)
    return F.size(F.split(bare, re.escape(sep)))


def _headers(lines: DataFrame, sep: str) -> DataFrame:
    """The first line of each file that is not blank, and the names in it: one row per file.

    Blocks of a file may be in any task, but its first block is in one, in the order of
    lines; so the header is the first of that block.
    """
    first = (
        lines.withColumn(_PLACE, F.monotonically_increasing_id())
        .filter((F.col(_BLOCK) == 0) & (F.trim("line") != ""))
        .groupBy(SOURCE_PATH)
        .agg(F.min_by("line", _PLACE).alias(_HEADER))
    )
    stored = written(first, "headers")
    widest = stored.agg(F.max(F.size(F.split(_HEADER, re.escape(sep))))).first()[0] or 1
    names = F.transform(
        _cells(F.col(_HEADER), sep, widest),
        lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "\\x{FEFF}", "")),
    )
    listed = names if widest == 1 else F.slice(names, F.lit(1), _count_cells(F.col(_HEADER), sep))
    return stored.withColumn(_NAMES, listed)


def parse_lines(
    lines: DataFrame,
    columns: Mapping[str, str] | Sequence[str],
    *,
    sep: str = ";",
    ragged: str = "fail",
) -> DataFrame:
    """Named columns of delimited lines (``read_lines``), each file by its own header.

    One pass finds the headers of all files, however many, and one reads the rows, so the
    number of jobs does not follow the number of files or of their layouts. Where all
    files share one header its positions are literals; else positions are joined by file.

    A row with more fields than its header fails the job, and one with fewer has nulls at its
    end; with ``ragged="mark"`` both stay, with ``REASON`` and ``LINE`` saying what is wrong, null
    in sound rows. Blank lines are no rows, nor is a line of the first block that repeats
    the header. A file without lines has no rows; a header that lacks a column fails before
    rows are read.
    """
    if ragged not in ("fail", "mark"):
        raise ValueError(f"ragged must be 'fail' or 'mark', not {ragged!r}")
    renames = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    headers = _headers(lines, sep)
    wanted = F.array(*[F.lit(c) for c in renames])
    absent = headers.withColumn("absent", F.array_except(wanted, _NAMES)).filter(F.size("absent") > 0).first()
    if absent:
        raise ValueError(
            f"source lacks columns {absent['absent']}; {absent[SOURCE_PATH]} has {absent[_NAMES]}"
        )
    layouts = headers.select(_HEADER, _NAMES).distinct().limit(2).collect()
    rows = lines.filter(F.trim("line") != "")
    if len(layouts) < 2:
        names = layouts[0][_NAMES] if layouts else list(renames)
        header = F.lit(layouts[0][_HEADER] if layouts else None).cast("string")
        places = {c: F.lit(names.index(c)) for c in renames}
        width, widest = F.lit(len(names)), len(names)
    else:
        widest = headers.agg(F.max(F.size(_NAMES))).first()[0]
        spots = headers.select(
            F.col(SOURCE_PATH).alias("__file"),
            _HEADER,
            F.size(_NAMES).alias("__width"),
            *[(F.array_position(_NAMES, c) - 1).cast("int").alias(f"__at_{i}") for i, c in enumerate(renames)],
        )
        small = headers.count() <= _BROADCAST_FILES
        rows = rows.join(F.broadcast(spots) if small else spots, F.col(SOURCE_PATH) == F.col("__file"))
        header, width = F.col(_HEADER), F.col("__width")
        places = {c: F.col(f"__at_{i}") for i, c in enumerate(renames)}
    repeats = (F.col(_BLOCK) == 0) & F.col("line").eqNullSafe(header)
    line = F.col("line")
    rows = rows.filter(~repeats).withColumn(_CELLS, _cells(line, sep, widest))
    count = _count_cells(line, sep)
    reason = F.when(count > width, F.lit(SURPLUS)).when(count < width, F.lit(SHORT))
    shown = []
    if ragged == "fail":
        stop = F.raise_error(F.concat(F.lit(f"{SURPLUS} in "), F.col(SOURCE_PATH), F.lit(": "), line))
        rows = rows.filter(F.when(count > width, stop.cast("boolean")).otherwise(True))
    else:
        rows = rows.withColumn(REASON, reason)
        shown = [F.col(REASON), F.when(F.col(REASON).isNotNull(), line).alias(LINE)]
    return rows.select(
        *[_present(F.get(_CELLS, places[c])).alias(target) for c, target in renames.items()],
        F.col(SOURCE_PATH),
        *shown,
    )


def absent_columns(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Iterable[str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """(source_path, column_name): columns that a file's header lacks, for all files at once."""
    lines = read_lines(spark.read, [paths] if isinstance(paths, str) else list(paths), encoding)
    wanted = F.array(*[F.lit(c) for c in columns])
    return _headers(lines, sep).select(
        SOURCE_PATH, F.explode(F.array_except(wanted, _NAMES)).alias("column_name")
    )


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Mapping[str, str] | Sequence[str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
    ragged: str = "fail",
) -> DataFrame:
    """Named columns of files, folders or lists of them, all as text, plus ``source_path``.

    Columns are found by the header name of each file, because yearly deliveries reorder
    them; see ``parse_lines`` for rows that do not fit. Nothing is inferred from the data.
    Cells do not span lines.
    """
    lines = read_lines(spark.read, [paths] if isinstance(paths, str) else list(paths), encoding)
    return parse_lines(lines, columns, sep=sep, ragged=ragged)


def read_table_export(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    *,
    sep: str = ";",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Named columns of exported spreadsheet tables: titles, a header row, data, notes.

    The header of a delivery (a file, or a folder of part files) is its line that holds all
    the names; columns are taken by name, in whatever order and beside whatever others they
    stand. A delivery without such a line fails the job. Lines that leave any column of the sheet empty, as titles
    and notes do, and the header itself are not rows. One pass finds the headers of all
    files, however many, and one reads the rows; cells do not span lines.
    """
    options = {"sep": sep, "mode": "PERMISSIVE"}
    text = F.decode(F.col("value").cast("binary"), encoding).alias("line")
    path = F.col("_metadata.file_path").alias(SOURCE_PATH)
    lines = spark.read.text(paths).select(text, path)
    lines = lines.withColumn("__delivery", delivery_name(F.col(SOURCE_PATH)))
    wanted = F.array(*[F.lit(c) for c in columns])

    def cells(line: Column, width: int) -> Column:
        fields = [f"c{i}" for i in range(width)]
        parsed = F.from_csv(line, ", ".join(f"{f} string" for f in fields), options)
        return F.array(*[parsed[f] for f in fields])

    widest = F.size(F.split(F.col("line"), re.escape(sep)))
    named = F.forall(wanted, lambda name: F.contains(F.col("line"), name))
    width = lines.filter(named).agg(F.max(widest)).first()[0] or len(columns)
    clean = F.transform(
        cells(F.col("line"), width), lambda c: F.trim(F.regexp_replace(c, "\\x{FEFF}", ""))
    )
    headers = lines.filter(named).select("__delivery", clean.alias("names"))
    headers = headers.filter(F.forall(wanted, lambda name: F.array_contains("names", name)))
    headers = headers.groupBy("__delivery").agg(F.min("names").alias("names"))
    absent = F.raise_error(F.concat(F.lit("no header row in "), F.col(SOURCE_PATH)))
    joined = lines.join(headers, "__delivery", "left").select(
        SOURCE_PATH,
        F.when(F.col("names").isNull(), absent.cast("array<string>")).otherwise(F.col("names")).alias("names"),
        cells(F.col("line"), width).alias("values"),
    )
    missing = F.array(*[F.lit(m) for m in MISSING_TEXTS])
    full = F.forall(
        F.arrays_zip("names", "values"),
        lambda x: x["names"].isNull() | (x["names"] == "")
        | F.coalesce(~F.array_contains(missing, x["values"]), F.lit(False)),
    )
    rows = joined.filter(full & (F.transform("values", lambda v: F.trim(v)) != F.col("names")))
    return rows.select(
        *[
            F.element_at("values", F.array_position("names", name).cast("int")).alias(name)
            for name in columns
        ],
        SOURCE_PATH,
    )
