"""The rows of the jobs that end in a sort come in that order."""

import pytest
from conftest import SF_ORACLE

from panelspark import catalog

SORTED = (
    "column_completeness", "group_distribution", "group_value_stats", "consistency_check", "group_percentiles",
    "growth_phases", "phase_effectiveness", "level_outcomes", "booster_outcomes", "inequality", "entity_rankings",
    "entity_coverage", "rolling_outliers", "global_trend", "peak_days", "lagged_association", "latest_coverage",
    "milestone_timeline",
)
#: What the rows are sorted by; rows that are equal in it may come in any order.
KEYS = {"column_completeness": "completeness_percentage", "consistency_check": "total_records"}


@pytest.mark.parametrize("query", [q for q in catalog.JOBS if q.name in SORTED], ids=lambda q: q.name)
def test_order(spark, duck_oracle, query):
    df = query.build(spark, SF_ORACLE)
    got = [tuple(r) for r in df.collect()]
    relation = duck_oracle.execute(query.oracle())
    names = [c[0] for c in relation.description]
    want = [tuple(dict(zip(names, r, strict=True))[c] for c in df.columns) for r in relation.fetchall()]
    at = [df.columns.index(KEYS[query.name])] if query.name in KEYS else range(min(2, len(df.columns)))
    pick = lambda rows: [tuple(r[i] for i in at) for r in rows]
    assert pick(got) == pick(want) and len(got) > 0
