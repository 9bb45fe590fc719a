"""Turn check results into a verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityGateError(RuntimeError):
    """At least one check failed; ``failures`` lists them."""

    def __init__(self, failures: list[str]):
        self.failures = failures
        super().__init__("quality gate failed: " + "; ".join(failures))


def summarise(results: DataFrame) -> DataFrame:
    """Checks passed and run per table, with its verdict."""
    return results.groupBy("table_name").agg(
        F.count_if("passed").alias("passed_checks"),
        F.count(F.lit(1)).alias("total_checks"),
        F.bool_and("passed").alias("passed"),
    )


def gate(results: DataFrame) -> int:
    """The number of checks that ran; raises unless all passed.

    Results hold one row per check, so collecting them is bounded by the suite.
    """
    rows = results.collect()
    failures = [
        f"{r.table_name}.{r.column_name} {r.check_name}: {r.unexpected} of {r.evaluated}" for r in rows if not r.passed
    ]
    if failures:
        raise QualityGateError(sorted(failures))
    return len(rows)
