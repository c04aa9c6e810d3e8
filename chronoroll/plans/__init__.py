"""Composed jobs: declarative ingest, audit and inventory, SQL catalog."""

from .audit import content_audit, fingerprint, inventory, list_region_folders, load_audit
from .catalog import ctas, register
from .ingest import IngestResult, prepare, read_ingested, read_range, read_table, run_ingest
from .replay import ReplayResult, open_rows, replay

__all__ = ["content_audit", "fingerprint", "ReplayResult", "open_rows", "replay", "read_range", "inventory", "list_region_folders", "load_audit", "ctas", "register",
           "IngestResult", "prepare", "read_ingested", "read_table", "run_ingest"]
