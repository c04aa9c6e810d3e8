"""Plan-shape tests: the scale properties the library promises, read from
the physical plans Catalyst produces."""

from chronoroll.plans.edge import raw_events, table
from chronoroll.plans.ingest import clean, prepare
from chronoroll.plans.suite import EVENTS_HOURLY, EVENTS_HOURLY_TYPED, INTERVALS
from chronoroll.sinks.files import layout
from chronoroll.spec import Dim, TableSpec


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_combines_map_side_and_parses_once(spark, sf_small):
    rows, _ = prepare(raw_events(table(spark, sf_small, "events")), EVENTS_HOURLY)
    plan = _plan(rows)
    assert "partial_count" in plan and "partial_sum" in plan
    assert plan.count("gettimestamp") == 1


def test_partitioned_write_is_rebalanced_not_single(spark, sf_small):
    rows, _ = prepare(raw_events(table(spark, sf_small, "events")), EVENTS_HOURLY)
    plan = _plan(layout(rows, ["event_type", "chunk"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "SinglePartition" not in plan


def test_interval_predicate_reaches_the_parquet_scan(spark, sf_small):
    spec = TableSpec(name="t", time_column="ts", dimensions=(Dim("event_type"),),
                     intervals=INTERVALS)
    good, _ = clean(table(spark, sf_small, "events"), spec)
    plan = _plan(good)
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00),LessThan(ts" in pushed


def test_typed_rollup_reads_only_needed_columns(spark, sf_small):
    good, _ = clean(table(spark, sf_small, "events"), EVENTS_HOURLY_TYPED)
    plan = _plan(good)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
