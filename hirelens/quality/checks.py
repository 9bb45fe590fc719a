"""Checks as DataFrames.

A result row is (table_name, check_name, column_name, evaluated, unexpected,
passed). Checks that look at one row at a time fuse into a single aggregate per
table, whatever their number. All uniqueness and relationship checks of a suite
share one more pass: every table is read once for all its key columns, and rows
are counted per (check, key) with map-side combine, so a hot key costs one row
per map task. Parents join that count as marked keys; there is no join.

Null rule: every check but ``not_null`` passes over nulls.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = ("table_name", "check_name", "column_name", "evaluated", "unexpected", "passed")


def _literal(value: str | int) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


@dataclass(frozen=True)
class Check:
    table: str
    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    condition: str | None = None
    parent: tuple[str, str] | None = None

    @property
    def fuses(self) -> bool:
        return self.kind not in ("unique", "relationship")

    def counts(self) -> tuple[str, str]:
        """SQL aggregates (evaluated, unexpected) of a check that fuses."""
        c = f"({self.condition or self.column})"
        match self.kind:
            case "not_null":
                return "count(1)", f"count_if({c} is null)"
            case "accepted_values":
                return f"count({c})", f"count_if({c} not in ({', '.join(map(_literal, self.values))}))"
            case "between":
                return f"count({c})", f"count_if({c} not between {self.low} and {self.high})"
            case "expression_true":
                return f"count({c})", f"count_if(not {c})"
            case "implies":
                return f"count_if({c})", f"count_if({c} and not (({self.values[0]}) <=> true))"
            case "row_count":
                return "count(1)", f"abs(count(1) - {self.values[0]})"
        raise ValueError(f"unknown check {self.kind}")

    def result(self, evaluated: str, unexpected: str) -> str:
        """SQL struct of a result row, from the two counts."""
        evaluated, unexpected = f"coalesce({evaluated}, 0L)", f"coalesce({unexpected}, 0L)"
        allowed = f"{evaluated} * {round(1 - self.mostly, 6)}BD"
        fields = [
            _literal(self.table),
            _literal(self.kind),
            _literal(self.column),
            evaluated,
            unexpected,
            f"{unexpected} <= {allowed}",
        ]
        return "struct(" + ", ".join(f"{field} as {name}" for field, name in zip(fields, RESULT)) + ")"


def not_null(table: str, column: str) -> Check:
    return Check(table, "not_null", column)


def unique(table: str, column: str) -> Check:
    return Check(table, "unique", column)


def accepted_values(table: str, column: str, values: Sequence) -> Check:
    return Check(table, "accepted_values", column, values=tuple(values))


def between(table: str, column: str, low: float, high: float, mostly: float = 1.0) -> Check:
    return Check(table, "between", column, low=low, high=high, mostly=mostly)


def expression_true(table: str, name: str, condition: str) -> Check:
    """``condition`` is SQL text over the table's columns; a null outcome passes."""
    return Check(table, "expression_true", name, condition=condition)


def implies(table: str, premise: str, conclusion: str) -> Check:
    """Where ``premise`` is true, ``conclusion`` must be true as well, null included."""
    return Check(table, "implies", premise, values=(conclusion,), condition=premise)


def row_count(table: str, expected: int) -> Check:
    return Check(table, "row_count", "*", values=(expected,), condition="1")


def relationship(table: str, column: str, parent: str, parent_column: str) -> Check:
    return Check(table, "relationship", column, parent=(parent, parent_column))


def with_values(checks: Sequence[Check], values: Mapping[str, Sequence]) -> list[Check]:
    """``checks`` with the accepted values of columns in ``values`` replaced."""
    return [
        replace(c, values=tuple(values[c.column])) if c.kind == "accepted_values" and c.column in values else c for c in checks
    ]


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with the rows that carry each."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return keys.join(parent.select(F.col(parent_column).alias(column)), column, "left_anti")


def _fused(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row-wise checks of one table: one scan, one aggregate, one row per check."""
    counts, rows = [], []
    for i, check in enumerate(checks):
        evaluated, unexpected = check.counts()
        counts += [F.expr(evaluated).alias(f"e{i}"), F.expr(unexpected).alias(f"u{i}")]
        rows.append(check.result(f"e{i}", f"u{i}"))
    return df.agg(*counts).selectExpr(f"inline(array({', '.join(rows)}))")


def _key_rows(df: DataFrame, columns: list[tuple[int, str]], rows: int, known: bool) -> DataFrame:
    """(check, key, rows, known) for the key columns of one table, in one scan."""
    keys = ", ".join(f"struct({i} as check, string({c}) as key)" for i, c in columns)
    return (
        df.selectExpr(f"inline(array({keys}))")
        .filter("key is not null")
        .selectExpr("check", "key", f"{rows}L as rows", f"{str(known).lower()} as known")
    )


def _keyed(frames: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """All uniqueness and relationship checks, whatever their tables."""
    children: dict[str, list[tuple[int, str]]] = {}
    parents: dict[str, list[tuple[int, str]]] = {}
    for i, check in enumerate(checks):
        children.setdefault(check.table, []).append((i, check.column))
        if check.parent:
            parents.setdefault(check.parent[0], []).append((i, check.parent[1]))
    spark = frames[checks[0].table].sparkSession
    # one empty row per check, so that a check of an empty table still reports
    parts = [spark.range(len(checks)).selectExpr("int(id) check", "string(null) key", "0L rows", "true known")]
    parts += [_key_rows(frames[table], columns, 1, False) for table, columns in children.items()]
    parts += [_key_rows(frames[table], columns, 0, True) for table, columns in parents.items()]
    per_key = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("check", "key")
        .agg(F.sum("rows").alias("rows"), F.bool_or("known").alias("known"))
    )
    counts = per_key.groupBy("check").agg(
        F.sum("rows").alias("evaluated"),
        F.expr("sum(rows) filter (where rows > 1)").alias("repeated"),
        F.expr("sum(rows) filter (where not known)").alias("orphaned"),
    )
    results = [
        check.result("evaluated", "repeated" if check.kind == "unique" else "orphaned") for check in checks
    ]
    return counts.selectExpr(f"element_at(array({', '.join(results)}), check + 1) as r").select("r.*")


def run_suite(frames: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Result rows of ``checks``; ``frames`` holds every table they name."""
    fusing: dict[str, list[Check]] = {}
    for check in checks:
        if check.fuses:
            fusing.setdefault(check.table, []).append(check)
    parts = [_fused(frames[table], mine) for table, mine in fusing.items()]
    keyed = [check for check in checks if not check.fuses]
    if keyed:
        parts.append(_keyed(frames, keyed))
    return reduce(DataFrame.unionByName, parts)
