"""Physical-plan properties that must hold for every registered query at any scale."""

import re

import pytest

from contrail.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

# Queries whose plan is only a read-back of written files or a driver-side status table.
SKIP = {"scheduled_run", "run_metrics"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_consumers(plan: str) -> list[str]:
    """Operators sitting directly on a single-partition exchange."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i > 0:
            out.append(lines[i - 1].strip())
    return out


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_is_scale_safe(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, "Python in the hot path"
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    for consumer in _single_partition_consumers(plan):
        # only one-row global aggregates (after a partial aggregate per task) may gather
        assert re.search(r"(Hash|ObjectHash|Sort)Aggregate\(keys=\[\]", consumer) or "TakeOrdered" in consumer, \
            f"{name}: single-partition exchange feeds {consumer}"


def test_scan_prunes_columns_and_pushes_filters(spark):
    from contrail.plans import indicators as I
    from contrail.sources.fixtures import Tables
    t = Tables(spark, SF_SMALL)
    plan = _plan(I.q1_airline_most_active(t.flights, t.airlines))
    orders_scan = [ln for ln in plan.splitlines() if "orders.parquet" in ln][0]
    # only the columns Q1 needs are read from the fact table
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string>" in orders_scan
    assert "PushedFilters: [IsNotNull(o_custkey)]" in orders_scan
