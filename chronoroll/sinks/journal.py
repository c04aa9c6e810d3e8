"""Changes of several folders of a table that a crash cannot leave half done.

The new files are first written whole to a staging folder inside the table
(``_staged``, which readers skip). A small journal then states everything that
is left to do, all of it file-system metadata: folders to swap in, files to
move in, folders to remove. Only when the journal is complete is it carried
out, and it is deleted last. A load that died before the journal was written
has changed nothing; one that died later is finished by ``recover``, which
every load of the table calls first. Each step can be repeated: what is
already moved is no longer staged.

One load at a time may change a table, as before; readers list either the old
or the new folder of a partition.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession

from ..session import (data_files, delete_path, list_files, make_dirs, move_path, path_exists, read_text,
                       write_text)

JOURNAL, STAGED = "_journal", "_staged"
# Fixed value: folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def staging_path(table: str) -> str:
    """A new staging folder of the table (not created)."""
    return f"{table.rstrip('/')}/{STAGED}/{uuid.uuid4().hex}"


def partition_folders(spark: SparkSession, path: str, partition_cols: list[str]) -> dict[str, dict]:
    """Folder (relative to ``path``) → values by column, of every partition that holds files.

    One listing by Spark, which lists many folders in parallel tasks; a null
    partition value is ``None``. Staged and journal folders are not seen.
    """
    out: dict[str, dict] = {}
    for rel in data_files(spark, path):
        folder = rel.rpartition("/")[0]
        if folder in out:
            continue
        parts = [p.partition("=") for p in folder.split("/")]
        if [name for name, _, _ in parts] == partition_cols:
            values = {name: unquote(value) for name, _, value in parts}
            out[folder] = {k: None if v == NULL_PARTITION else v for k, v in values.items()}
    return out


def announce(spark: SparkSession, table: str, staged: str, replace: list[str] = (), remove: list[str] = (),
             add: dict[str, str] | None = None, below: str = "") -> str:
    """Write the journal of a change, which from now on will be carried out; returns its path.

    ``replace``: partition folders below ``staged`` that take the place of the
    table's (of the same name, without ``below`` in front); ``remove``: folders
    of the table that go; ``add``: files below ``staged`` and the place in the
    table each moves to.
    """
    table = table.rstrip("/")
    entry = {"staged": staged, "replace": sorted((f, f.removeprefix(below)) for f in replace),
             "remove": sorted(remove), "add": sorted((add or {}).items())}
    make_dirs(spark, f"{table}/{JOURNAL}")
    # an entry is complete once it has its name: it is written under another one
    name = f"{table}/{JOURNAL}/{uuid.uuid4().hex}"
    write_text(spark, f"{name}.tmp", json.dumps(entry))
    move_path(spark, f"{name}.tmp", f"{name}.json")
    return f"{name}.json"


def commit(spark: SparkSession, table: str, staged: str, **change) -> None:
    """Announce a change and carry it out."""
    _carry_out(spark, table.rstrip("/"), announce(spark, table, staged, **change))


def _carry_out(spark: SparkSession, table: str, journal: str) -> None:
    entry = json.loads(read_text(spark, journal))
    staged = entry["staged"]
    for src, dst in entry["replace"]:
        if path_exists(spark, f"{staged}/{src}"):
            delete_path(spark, f"{table}/{dst}")
            move_path(spark, f"{staged}/{src}", f"{table}/{dst}")
    for src, dst in entry["add"]:
        if path_exists(spark, f"{staged}/{src}"):
            move_path(spark, f"{staged}/{src}", f"{table}/{dst}")
    for folder in entry["remove"]:
        delete_path(spark, f"{table}/{folder}")
    delete_path(spark, staged)
    delete_path(spark, journal)


def recover(spark: SparkSession, table: str) -> int:
    """Finish the changes that a load of the table began but did not end; returns their number."""
    table = table.rstrip("/")
    done = 0
    for name in list_files(spark, f"{table}/{JOURNAL}"):
        if name.endswith(".json"):
            _carry_out(spark, table, f"{table}/{JOURNAL}/{name}")
            done += 1
    delete_path(spark, f"{table}/{JOURNAL}")
    delete_path(spark, f"{table}/{STAGED}")      # of loads that died before their journal
    return done
