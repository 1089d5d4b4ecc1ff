"""Names that test modules import; conftest.py holds fixtures only."""

SMALL = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
