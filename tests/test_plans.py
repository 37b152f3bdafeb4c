"""Driver contract and plan shape checks."""
import __spark_entry__ as E

from retention_engine.operators import metrics as M
from retention_engine.sources import adapters

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and "ap" in df.columns and "recall_at_10" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) > 100


def _single_partition_children(plan: str):
    lines = plan.split("\n")
    return [lines[i + 1] for i, line in enumerate(lines) if "Exchange SinglePartition" in line and i + 1 < len(lines)]


def test_row_level_ranks_never_gather_raw_rows(spark):
    """Only aggregated data (a score histogram, ≤ 1e6+1 rows per group, or partial aggregates) may be
    moved to a single partition; raw rows are ranked in chunks."""
    s = adapters.customer_snapshot(spark, SF)
    for df in (M.recall_at_k(s), M.gain_curve(s), M.evaluate(s, by=["segment"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for child in _single_partition_children(plan):
            assert "Aggregate" in child, child
