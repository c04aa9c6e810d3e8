"""Relational operators: cleaning, rollup, lookup, union."""

from .clean import (BAD_REASON, MALFORMED, RAW_TIME, bad_reason, coerce_columns, coerce_dims, exclude,
                    filter_intervals, filter_partition, interval_predicate, keep_rows, parsed_messages, preview, project,
                    rename_positional, split_bad, stamp, tag, with_event_time, with_expr)
from .distinct import bitmap_states, count_bitmaps, merge_bitmaps, theta_counts, theta_sets
from .lookup import lookup, with_lookups
from .rollup import (bucket, counts_by, detail, distinct_values, exact_distinct, finish,
                     histogram_bins, quantiles, reaggregate, roll, rollup, sketch_summary)
from .union import union_by_name, union_by_position

__all__ = ["BAD_REASON", "MALFORMED", "RAW_TIME", "bad_reason", "coerce_columns", "coerce_dims", "exclude",
           "filter_intervals", "filter_partition", "interval_predicate", "keep_rows",
           "parsed_messages", "preview", "project",
           "rename_positional", "split_bad", "stamp", "tag", "with_event_time", "with_expr",
           "lookup", "with_lookups", "bitmap_states", "count_bitmaps", "merge_bitmaps", "theta_counts", "theta_sets",
           "histogram_bins", "bucket", "counts_by", "detail", "distinct_values",
           "exact_distinct", "finish", "quantiles", "reaggregate", "roll", "rollup",
           "sketch_summary", "union_by_name", "union_by_position"]
