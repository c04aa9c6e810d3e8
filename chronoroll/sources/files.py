"""File sources: region-partitioned CSV, single CSV, positional CSV, Parquet,
and CSV lines held in a column.

CSV is read in the dialect of public exports (``CSV_DIALECT``: a quote in a
quoted cell is written twice); ``options`` are Spark's and win over it. A cell
may hold a line break only with ``multiLine``, which makes a file one task;
without it such a cell's lines are records of their own, set aside as malformed.

Every reader is one Spark scan over a path glob. There is no driver-side loop
over folders or files: the region of a row comes from the path of the file
that holds it (``_metadata.file_path``), so ten regions or ten thousand cost
the same planning work and the scan is split by Spark's file splitter.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import CSV_DIALECT, parse_csv_line, region_from_path
from ..operators.clean import MALFORMED

FILE_PATH = "_metadata.file_path"


def _string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _marked(reader, columns: list[str]):
    """A CSV reader that gives a line with too few or too many fields, or a broken
    quote, in the column ``_malformed``. Column pruning is off for it: a pruned
    parse would not see what is wrong with a line."""
    return (reader.schema(_string_schema([*columns, MALFORMED]))
            .option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", "false"))


def _csv(spark: SparkSession, options: dict | None):
    """A CSV reader of the library's dialect; ``options`` of Spark's reader win over it."""
    return spark.read.format("csv").options(**{**CSV_DIALECT, "mode": "PERMISSIVE",
                                               **{k: str(v) for k, v in (options or {}).items()}})


def _load(reader, path: str | list[str]) -> DataFrame:
    try:
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"no input matches {path}") from e
        raise


_GLOB_SPECIAL = "\\{}[]*?,"


def region_glob(glob: str, regions: list[str] | None) -> str:
    """Narrow the folder part of ``*/…`` to the given regions.

    Each region matches a plain folder (``austin``) or a ``key=value`` folder
    (``city=austin``); glob characters in names are escaped. Only the
    matching folders are then listed and read.
    """
    if not regions:
        return glob
    if not glob.startswith("*/"):
        raise ValueError("regions need a glob of the form '*/<file pattern>'")
    esc = ["".join("\\" + ch if ch in _GLOB_SPECIAL else ch for ch in r) for r in regions]
    alts = ",".join(a for r in esc for a in (r, f"*={r}"))
    return "{" + alts + "}" + glob[1:]


def read_partitioned_csv(spark: SparkSession, base: str, columns: list[str] | None = None,
                         partition_col: str = "region", glob: str = "*/*.csv",
                         strict: bool = True, infer: bool = False,
                         keep_file: bool = False, options: dict | None = None,
                         regions: list[str] | None = None, malformed: bool = False) -> DataFrame:
    """Read every CSV of every region folder below ``base``.

    ``columns`` declares the header: all columns are read as text and typed
    later with ``coerce`` (P3), so one bad cell nulls one value instead of
    failing the load. With ``strict`` the header of every file must carry
    exactly these names in this order (``enforceSchema=false``); otherwise
    columns are taken by position. Without ``columns`` the header of the
    files names the columns (``infer`` also guesses types, which costs one
    extra pass over the data).

    Files outside ``glob`` (a non-CSV file in a region folder, a stray file
    next to the folders) are not read. A region folder with no CSV yields no
    rows; ``plans.audit.inventory`` reports it. ``regions`` restricts the
    read to those region folders at listing time (a filter on the derived
    region column could not skip any file). ``malformed`` (with ``columns``)
    adds ``_malformed``, the text of a line that has not these columns.
    """
    r = _csv(spark, options).option("header", "true")
    if columns:
        r = _marked(r, columns) if malformed else r.schema(_string_schema(columns))
        r = r.option("enforceSchema", str(not strict).lower())
    elif infer:
        r = r.option("inferSchema", "true")
    df = _load(r, f"{base.rstrip('/')}/{region_glob(glob, regions)}")
    df = df.withColumn(partition_col, region_from_path(F.col(FILE_PATH)))
    if keep_file:
        df = df.withColumn("_file", F.col(FILE_PATH))
    return df


def read_csv(spark: SparkSession, path: str | list[str], infer: bool = True, header: bool = True,
             options: dict | None = None, malformed: bool = False) -> DataFrame:
    """One CSV file or folder, header row, types inferred.

    ``malformed`` (not with ``infer``) adds ``_malformed``, the text of a
    line that has not the header's columns.

    Inference is a separate job over the input; use a declared schema
    (``read_csv_positional`` or ``read_partitioned_csv(columns=…)``) for
    large inputs.
    """
    r = (_csv(spark, options).option("header", str(header).lower())
         .option("inferSchema", str(infer).lower()))
    df = _load(r, path)
    return _load(_marked(r, df.columns), path) if malformed and not infer else df


def read_csv_positional(spark: SparkSession, path: str | list[str], columns: list[str],
                        skip_header: bool | int = True, options: dict | None = None,
                        malformed: bool = False) -> DataFrame:
    """CSV with declared column names taken by position; header discarded (S3).

    Columns are read as text; apply ``coerce`` for declared types. A file with
    fewer fields null-pads the missing columns; ``malformed`` adds
    ``_malformed``, the text of such a line. ``skip_header`` may be the number
    of lines to leave out at the start of every file (beyond one, a quoted
    cell can't hold a line break).
    """
    if int(skip_header) > 1:
        lines = skip_lines(spark, path, int(skip_header))
        names = [*columns, MALFORMED] if malformed else columns
        ddl = ", ".join(f"`{c}` STRING" for c in names)
        opts = {"columnNameOfCorruptRecord": MALFORMED, **CSV_DIALECT, **(options or {})}
        row = F.from_csv("value", ddl, {k: str(v) for k, v in opts.items()}).alias("_row")
        return lines.select(row, "file_path").select("_row.*", "file_path")
    r = _csv(spark, options)
    r = _marked(r, columns) if malformed else r.schema(_string_schema(columns))
    r = r.option("header", str(bool(skip_header)).lower()).option("enforceSchema", "true")
    return _load(r, path)


def skip_lines(spark: SparkSession, path: str | list[str], n: int) -> DataFrame:
    """Text lines (``value``, ``file_path``) without the first ``n`` of every file.

    Only the block at a file's start is counted, in the task that reads it;
    a header longer than one scan block is not supported.
    """
    lines = _load(spark.read.format("text"), path).select(
        "value", F.col(FILE_PATH).alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"))

    def run(batches):
        seen: dict[str, int] = {}
        for batch in batches:
            keep_row = []
            for file, start in zip(batch.column("file_path").to_pylist(),
                                   batch.column("block_start").to_pylist(), strict=True):
                k = seen.get(file, 0)
                keep_row.append(start > 0 or k >= n)
                if start == 0 and k < n:
                    seen[file] = k + 1
            yield batch.filter(pa.array(keep_row)).select(["value", "file_path"])

    return lines.mapInArrow(run, "value string, file_path string")


def read_parquet(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Parquet scan with the schema from the files.

    ``glob`` is a path pattern below ``path`` (``*/*.parquet``, a table's
    folder or file name); ``path`` may be a list of files and folders.
    """
    if glob:
        path = [f"{p.rstrip('/')}/{glob}" for p in ([path] if isinstance(path, str) else path)]
    return _load(spark.read.format("parquet"), path)


def from_csv_lines(df: DataFrame, col: str, ddl: str, keep: list[str] | None = None,
                   sep: str = ",", options: dict | None = None) -> DataFrame:
    """Parse a column of CSV lines in parallel into typed columns."""
    parsed = parse_csv_line(col, ddl, sep, options).alias("_row")
    return df.select(*(keep or []), parsed).select(*(keep or []), "_row.*")
