from __future__ import annotations

from pyspark.sql import DataFrame


def python_nodes(df: DataFrame) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if any(x in line for x in ("Python", "Pandas", "Arrow"))]
