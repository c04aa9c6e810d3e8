"""Value functions: typed coercion, region name from a file path, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spec type name → Spark SQL type.
SPARK_TYPES = {"string": "string", "long": "bigint", "double": "double",
               "float": "float", "boolean": "boolean"}


# The CSV dialect of public exports (RFC 4180): a quote inside a quoted cell is
# written twice, a backslash is an ordinary character. Spark's own default
# (``escape="\\"``) is an option of every reader and writer.
CSV_DIALECT = {"quote": '"', "escape": '"'}
# A cell is written as it is: white space at its ends belongs to it.
CSV_WRITER = {**CSV_DIALECT, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coerce(c: Column | str, type_name: str) -> Column:
    """Cast to a spec type; text that does not convert becomes null.

    ``try_cast`` keeps the ANSI-mode engine from failing the whole job on one
    bad cell (plain ``cast`` raises under ANSI). Text is trimmed first, so
    `` 12 `` reads as 12 the way a CSV reader would. A long may be written
    with a decimal point and zeros (``400.0``, as tools export an integer
    column with gaps); with any other fraction it becomes null.
    """
    t = SPARK_TYPES[type_name.lower()]
    col = _c(c)
    if t == "string":
        return col.cast("string")
    text = F.trim(col.cast("string"))
    return exact_long(text) if t == "bigint" else text.try_cast(t)


def exact_long(c: Column) -> Column:
    """Text as a long, also one with a decimal point and zeros; null for any other text."""
    exact = c.try_cast("decimal(38,9)")
    return F.coalesce(c.try_cast("bigint"),
                      F.when(exact == F.floor(exact), exact.try_cast("bigint")))


def region_from_path(path: Column | str) -> Column:
    """Name of the folder that holds a file: ``…/<region>/<file>`` → region.

    Accepts both plain folders (``raw/click/a.csv``) and ``key=value``
    folders written by a partitioned writer (``raw/event_type=click/…``),
    and undoes URI escaping of the path (``%20`` → space; ``+`` stays ``+``).
    Plain string slicing, no regular expression: it runs once per row.
    """
    p = _c(path)
    folder = F.substring_index(F.substring_index(p, "/", -2), "/", 1)
    name = F.substring_index(folder, "=", -1)
    decoded = F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(name.contains("%"), F.coalesce(decoded, name)).otherwise(name)


def parse_json(c: Column | str, ddl: str, malformed: str | None = None) -> Column:
    """Parse a JSON text column to a struct with the given DDL schema.

    Malformed text yields a struct of nulls (PERMISSIVE), never an error;
    ``malformed`` names a further field that then holds the text.
    """
    options = {"mode": "PERMISSIVE"}
    if malformed:
        ddl, options = f"{ddl}, `{malformed}` STRING", {**options, "columnNameOfCorruptRecord": malformed}
    return F.from_json(_c(c), ddl, options)


def to_json_value(cols: list[str] | None = None) -> Column:
    """One JSON text per row, as a message ``value`` column."""
    inner = F.struct(*(cols or ["*"]))
    return F.to_json(inner, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def parse_csv_line(c: Column | str, ddl: str, sep: str = ",", options: dict | None = None) -> Column:
    """Parse one CSV line per row into a struct (``from_csv``), in the dialect above.

    The whole text is one record, so a quoted cell may hold line breaks.
    """
    return F.from_csv(_c(c), ddl, {**CSV_DIALECT, "sep": sep, "mode": "PERMISSIVE", **(options or {})})


def to_csv_line(*cols: Column | str, options: dict | None = None) -> Column:
    """One CSV line of the columns, which ``parse_csv_line`` reads back."""
    return F.to_csv(F.struct(*cols), {**CSV_WRITER, **(options or {})})
