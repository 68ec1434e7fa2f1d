"""Look at physical plans."""


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def exchanges(df) -> int:
    """Shuffles in the plan, broadcasts not counted."""
    simple = df._jdf.queryExecution().executedPlan().toString()
    return sum(1 for line in simple.splitlines() if "Exchange " in line and "BroadcastExchange" not in line and "ReusedExchange" not in line)
