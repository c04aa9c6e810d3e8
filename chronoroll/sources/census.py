"""CSV files of one set whose headers differ: a census of the headers, then one scan per header.

Public exports change over the years: columns are added, dropped or put in
another order. Spark takes the header of one file for all. Here the header
lines are read in tasks, the files are grouped by their header, each group is
one scan by its own columns, and the scans are united by name. A column a
file does not have is null in its rows.
"""

from __future__ import annotations

import csv
import io
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import CSV_DIALECT, region_from_path
from ..operators.clean import MALFORMED
from ..operators.union import union_by_name
from .files import _GLOB_SPECIAL, FILE_PATH, _csv, _load, _marked, _string_schema, region_glob



def headers(spark: SparkSession, path: str | list[str], options: dict | None = None) -> DataFrame:
    """(file, columns): the columns of the first line of every file that has one.

    One pass of the text source; only lines of the blocks at a file's start
    leave the JVM, and one row a file leaves the tasks. Names are trimmed, a
    blank one is named after its place (``_c2``).
    """
    o = {**CSV_DIALECT, **(options or {})}
    sep, quote = str(o.get("sep", ",")), str(o.get("quote", '"'))
    double = o.get("escape") == quote
    lines = _load(spark.read.format("text"), path).select(
        "value", F.col(FILE_PATH).alias("file"), F.col("_metadata.file_block_start").alias("start")).where("start = 0")

    def run(batches):
        seen: set[str] = set()
        for batch in batches:
            files, names = [], []
            # a file's lines come in order, so its first row here is its first line
            for file in batch.column("file").unique().to_pylist():
                if file in seen:
                    continue
                seen.add(file)
                first = batch.column("value")[pc.index(batch.column("file"), file).as_py()].as_py() or ""
                row = next(csv.reader(io.StringIO(first.removeprefix("\ufeff")), delimiter=sep, quotechar=quote, doublequote=double), [])
                files.append(file)
                names.append([c.strip() or f"_c{i}" for i, c in enumerate(row)])
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(names, pa.list_(pa.string()))], names=["file", "columns"])

    return lines.mapInArrow(run, "file string, columns array<string>")


def _as_path(uri: str) -> str:
    """A listed file as a path to load: escapes undone, glob characters taken as they are."""
    return "".join("\\" + ch if ch in _GLOB_SPECIAL else ch for ch in unquote(uri))


def read_csv_census(spark: SparkSession, path: str | list[str], columns: list[str] | None = None,
                    partition_col: str | None = None, malformed: bool = False, keep_file: bool = False,
                    options: dict | None = None, regions: list[str] | None = None, glob: str = "*/*.csv") -> DataFrame:
    """CSV files with headers of their own, united by column name.

    All cells are text. ``columns`` are the columns of the result, in order
    (others are left out, one that no file has is null); by default all names
    of the headers, the commonest header's first. With ``partition_col`` the
    path is the base of region folders (``regions`` and ``glob`` as in
    ``read_partitioned_csv``). ``malformed`` adds ``_malformed``, the text of
    a line that has not its file's columns. Empty files have no header and
    no rows; a header that names a column twice is an error.
    """
    if partition_col:
        if not isinstance(path, str):
            raise ValueError("partition_col needs one base folder")
        path = f"{path.rstrip('/')}/{region_glob(glob, regions)}"
    # one row per distinct header; the files of a header are the listing the scan needs anyway
    groups = (headers(spark, path, options).groupBy("columns").agg(F.sort_array(F.collect_list("file")).alias("files"))
              .collect())
    groups = sorted(groups, key=lambda g: (-len(g["files"]), g["columns"]))
    for g in groups:
        if len(set(g["columns"])) < len(g["columns"]):
            raise ValueError(f"a column is named twice in the header of {g['files'][0]}")
    wanted = columns or list(dict.fromkeys(c for g in groups for c in g["columns"]))
    extra = ([MALFORMED] if malformed else []) + ([partition_col] if partition_col else []) + (["_file"] if keep_file else [])
    frames = []
    for g in groups:
        r = _csv(spark, options).option("header", "true").option("enforceSchema", "true")
        r = _marked(r, g["columns"]) if malformed else r.schema(_string_schema(g["columns"]))
        df = r.load(path if len(groups) == 1 else [_as_path(f) for f in g["files"]])
        if partition_col:
            df = df.withColumn(partition_col, region_from_path(F.col(FILE_PATH)))
        if keep_file:
            df = df.withColumn("_file", F.col(FILE_PATH))
        frames.append(df.select(*[F.col(f"`{c}`") for c in df.columns if c in wanted or c in extra]))
    if not frames:
        return spark.createDataFrame([], _string_schema([*wanted, *extra]))
    out = union_by_name(frames)
    return out.select(*[F.col(f"`{c}`") if c in out.columns else F.lit(None).cast("string").alias(c) for c in [*wanted, *extra]])
