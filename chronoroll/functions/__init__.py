"""Scalar functions (all built-in Catalyst expressions)."""

from .time import (REFERENCE_TIME_FORMAT, chunk_label, event_time, floor_time,
                   format_reference_time, format_run_id, interval_bounds,
                   is_blank, ntz_literal, parse_time, run_id)
from .values import (coerce, parse_csv_line, parse_json, region_from_path,
                     to_json_value)

__all__ = ["REFERENCE_TIME_FORMAT", "chunk_label", "event_time", "floor_time",
           "format_reference_time", "format_run_id", "interval_bounds", "is_blank",
           "ntz_literal", "parse_time", "run_id", "coerce", "parse_csv_line",
           "parse_json", "region_from_path", "to_json_value"]
