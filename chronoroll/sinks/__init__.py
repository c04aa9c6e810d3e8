"""Sinks: partitioned file tables, snapshots, JSON messages, JDBC."""

from .files import (CHUNK, append_table, layout, publish_json, replace_partitions,
                    replace_scope, snapshot_path, with_chunk, write_snapshot, write_snapshot_and_latest,
                    write_table)
from .journal import recover
from .jdbc import jdbc_write_options, write_jdbc

__all__ = ["CHUNK", "append_table", "layout", "publish_json", "replace_partitions",
           "recover", "replace_scope", "snapshot_path", "with_chunk", "write_snapshot", "write_snapshot_and_latest",
           "write_table", "jdbc_write_options", "write_jdbc"]
