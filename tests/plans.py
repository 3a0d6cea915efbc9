"""Reads the physical plan Spark chose."""


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    """Shuffles in the plan; broadcasts and reused exchanges do not count."""
    return sum(
        line.lstrip(" :+-*()0123456789").startswith("Exchange ")
        for line in plan_text(df).splitlines()
    )
