"""Declarative column checks, compiled to Spark aggregations.

A suite is a list of :class:`Check`. All row-level checks of a suite share one aggregation, each uniqueness
check adds one grouping by its column, and schema checks never touch the data.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# The check types as they appear in reports.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
EXISTS = "expect_column_to_exist"
OF_TYPE = "expect_column_values_to_be_of_type"
IN_TYPE_LIST = "expect_column_values_to_be_in_type_list"
NON_NULL_SHARE = "expect_column_proportion_of_non_null_values_to_be_between"

# Type names a suite may use and the Spark types they stand for.
TYPE_NAMES = {
    "float64": "double",
    "float32": "float",
    "int64": "bigint",
    "int32": "int",
    "bool": "boolean",
    "str": "string",
    "string": "string",
}

_ROW_LEVEL = {NOT_NULL, BETWEEN, IN_SET}
_SCHEMA_LEVEL = {EXISTS, OF_TYPE, IN_TYPE_LIST}

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("expectation", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("element_count", T.LongType()),
        T.StructField("missing_count", T.LongType()),
        T.StructField("missing_percent", T.DoubleType()),
        T.StructField("unexpected_count", T.LongType()),
        T.StructField("unexpected_percent", T.DoubleType()),
        T.StructField("unexpected_percent_total", T.DoubleType()),
        T.StructField("unexpected_percent_nonmissing", T.DoubleType()),
        T.StructField("observed_value", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Check:
    """One expectation on one column."""

    expectation: str
    column: str
    severity: str = "critical"
    mostly: float = 1.0
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()

    def unexpected_sql(self) -> str:
        """Condition that is true on rows that break the check and never null."""
        c = f"`{self.column}`"
        if self.expectation == NOT_NULL:
            return f"{c} IS NULL"
        if self.expectation == IN_SET:
            broken = f"{c} NOT IN ({', '.join(_sql(value) for value in self.allowed)})"
        elif self.expectation == BETWEEN:
            bounds = [f"{c} {sign} {_sql(v)}" for sign, v in (("<", self.low), (">", self.high)) if v is not None]
            broken = " OR ".join(bounds) or "false"
        else:
            raise ValueError(f"{self.expectation} has no row-level form")
        return f"{c} IS NOT NULL AND ({broken})"

    def unexpected(self) -> Column:
        return F.expr(self.unexpected_sql())


def _sql(value: object) -> str:
    """A Python value as a SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def not_null(column: str, mostly: float = 1.0, severity: str = "critical") -> Check:
    return Check(NOT_NULL, column, severity, mostly)


def unique(column: str) -> Check:
    return Check(UNIQUE, column)


def between(column: str, low=None, high=None, mostly: float = 1.0, severity: str = "critical") -> Check:
    return Check(BETWEEN, column, severity, mostly, low, high)


def in_set(column: str, *allowed) -> Check:
    return Check(IN_SET, column, allowed=allowed)


def exists(*columns: str) -> list[Check]:
    return [Check(EXISTS, name) for name in columns]


def of_type(column: str, type_name: str, severity: str = "warning") -> Check:
    return Check(OF_TYPE, column, severity, allowed=(type_name,))


def in_type_list(column: str, *type_names: str, severity: str = "warning") -> Check:
    return Check(IN_TYPE_LIST, column, severity, allowed=type_names)


def non_null_share(column: str, low: float, high: float, severity: str = "warning") -> Check:
    return Check(NON_NULL_SHARE, column, severity, low=low, high=high)


#: Counters of one check before shares are taken. ``decided`` is set for checks that need no counting.
_COUNTED_FIELDS = {
    "position": "int",
    "expectation": "string",
    "column": "string",
    "severity": "string",
    "mostly": "double",
    "low": "double",
    "high": "double",
    "decided": "boolean",
    "total": "bigint",
    "missing": "bigint",
    "unexpected": "bigint",
    "observed_value": "string",
}


def _counted(position: int, check: Check, **counts: str) -> str:
    """One check's row of counters as a SQL struct; ``counts`` are SQL expressions.

    Suites are long and a struct has many fields, so they are written as SQL: one parsed expression instead
    of hundreds of calls to build it.
    """
    share = check.expectation == NON_NULL_SHARE
    known = {
        "position": _sql(position),
        "expectation": _sql(check.expectation),
        "column": _sql(check.column),
        "severity": _sql(check.severity),
        "mostly": _sql(float(check.mostly)),
        "low": _sql(check.low if share else None),
        "high": _sql(check.high if share else None),
        **counts,
    }
    fields = [f"'{name}', CAST({known.get(name, 'NULL')} AS {kind})" for name, kind in _COUNTED_FIELDS.items()]
    return f"named_struct({', '.join(fields)})"


def _unpacked(structs: Sequence[str]) -> Column:
    return F.expr(f"inline(array({', '.join(structs)}))")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def _with_shares(counted: DataFrame) -> DataFrame:
    """Results from counters, computed once for all checks."""
    kind, total, missing, unexpected = (F.col(c) for c in ("expectation", "total", "missing", "unexpected"))
    # Nulls are what a not-null check counts, so there every row takes part; elsewhere nulls are left out.
    judged = F.when(kind == NOT_NULL, total).otherwise(total - missing)
    share = F.when(total > 0, (total - missing) / total).otherwise(F.lit(0.0))
    is_share = kind == NON_NULL_SHARE
    measured = unexpected.isNotNull()
    beside_nulls = measured & (kind != NOT_NULL)
    success = (
        F.when(F.col("decided").isNotNull(), F.col("decided"))
        .when(is_share, share.between(F.col("low"), F.col("high")))
        .otherwise(judged - unexpected >= judged * F.col("mostly"))
    )
    values = {
        "success": success,
        "element_count": F.when(measured, total),
        "missing_count": F.when(beside_nulls, missing),
        "missing_percent": F.when(beside_nulls, _percent(missing, total)),
        "unexpected_count": unexpected,
        "unexpected_percent": F.when(measured, _percent(unexpected, judged)),
        "unexpected_percent_total": F.when(beside_nulls, _percent(unexpected, total)),
        "unexpected_percent_nonmissing": F.when(beside_nulls, _percent(unexpected, judged)),
        "observed_value": F.when(is_share, F.round(share, 6).cast("string")).otherwise(F.col("observed_value")),
    }
    return counted.select(
        *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA]
    )


def _schema_check(position: int, check: Check, types: dict[str, str]) -> str:
    found = types.get(check.column)
    if check.expectation == EXISTS:
        return _counted(position, check, decided=_sql(found is not None))
    wanted = {TYPE_NAMES.get(name, name) for name in check.allowed}
    return _counted(position, check, decided=_sql(found in wanted), observed_value=_sql(found))


def same_value(c: Column, kind: T.DataType) -> list[Column]:
    """Columns that are equal where the values are and ``k`` null where they are null: texts as 128 bits, so neither memory nor
    shuffle grows with their lengths."""
    if not isinstance(kind, T.StringType) or not kind.isUTF8BinaryCollation():
        return [c.alias("k")]
    return [F.when(c.isNotNull(), F.xxhash64(c)).alias("k"), F.xxhash64(F.lit("second"), c).alias("k2")]


def _unique_check(df: DataFrame, position: int, check: Check) -> DataFrame:
    """Every row of a repeated value is unexpected; nulls are missing, not repeated."""
    groups = df.groupBy(*same_value(F.col(f"`{check.column}`"), df.schema[check.column].dataType)).agg(F.count(F.lit(1)).alias("n"))
    counters = groups.agg(
        F.expr("coalesce(sum(n), 0) AS total"),
        F.expr("coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS missing"),
        F.expr("coalesce(sum(n) FILTER (WHERE k IS NOT NULL AND n > 1), 0) AS unexpected"),
    )
    counted = _counted(position, check, total="total", missing="missing", unexpected="unexpected")
    return counters.select(_unpacked([counted]))


def evaluate(df: DataFrame, suite: Sequence[Check]) -> DataFrame:
    """One result row per check, in suite order by ``position``."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    counters = {"total": "count(1)"}
    shared: list[str] = []
    grouped: list[DataFrame] = []
    for position, check in enumerate(suite):
        if check.expectation in _SCHEMA_LEVEL:
            shared.append(_schema_check(position, check, types))
        elif check.column not in types:
            shared.append(_counted(position, check, decided="false"))
        elif check.expectation == UNIQUE:
            grouped.append(_unique_check(df, position, check))
        else:
            measured = {"total": "total"}
            if check.expectation != NOT_NULL:
                counters[f"present_{check.column}"] = f"count(`{check.column}`)"
                measured["missing"] = f"total - `present_{check.column}`"
            if check.expectation in _ROW_LEVEL:
                counters[f"unexpected_{position}"] = f"count_if({check.unexpected_sql()})"
                measured["unexpected"] = f"unexpected_{position}"
            shared.append(_counted(position, check, **measured))
    parts = list(grouped)
    if shared:
        one_row = df.agg(*[F.expr(f"{sql} AS `{name}`") for name, sql in counters.items()])
        parts.insert(0, one_row.select(_unpacked(shared)))
    return _with_shares(reduce(DataFrame.unionByName, parts))


def unexpected_sample(df: DataFrame, check: Check, n: int = 20) -> DataFrame:
    """The first ``n`` unexpected values in ascending order, for reports."""
    value = F.col(check.column)
    if check.expectation == UNIQUE:
        # The repeated values and their counts say it all; the rows themselves need not be found again.
        groups = df.where(value.isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        first = groups.where(F.col("_n") > 1).orderBy(check.column).limit(n)
        copies = F.array_repeat(value, F.least("_n", F.lit(n)).cast("int"))
        return first.select(F.explode(copies).alias(check.column)).orderBy(check.column).limit(n)
    return df.where(check.unexpected()).select(check.column).orderBy(F.asc_nulls_first(check.column)).limit(n)


@dataclass
class Outcome:
    """Result of one suite run; its size is that of the suite, not of the data."""

    entity: str
    success: bool
    results: list[Row]
    samples: dict[int, list] = field(default_factory=dict)

    @property
    def failed(self) -> list[Row]:
        return [row for row in self.results if not row["success"]]


class SuiteFailed(RuntimeError):
    """A gate stopped the run."""


def run_suite(df: DataFrame, entity: str, suite: Sequence[Check], sample: int = 20) -> Outcome:
    """Evaluate a suite and fetch samples of unexpected values for the checks that failed.

    A failed check fails the suite whatever its severity.
    """
    results = sorted(evaluate(df, suite).collect(), key=lambda row: row["position"])
    samples = {}
    for row in results:
        check = suite[row["position"]]
        sampled = check.expectation in _ROW_LEVEL | {UNIQUE} and check.column in df.columns
        if sampled and not row["success"]:
            values = [r[0] for r in unexpected_sample(df, check, sample).collect()]
            samples[row["position"]] = values
            log.warning("%s: %s(%s), for example %s", entity, check.expectation, check.column, values[:5])
    return Outcome(entity, all(row["success"] for row in results), results, samples)


def report(outcome: Outcome, suite: Sequence[Check], **about: str) -> dict:
    """The report document of one run; ``about`` says which run and which table it is on."""
    expectations = []
    for row in outcome.results:
        check = suite[row["position"]]
        arguments = {
            "column": check.column,
            "mostly": check.mostly if check.mostly != 1.0 else None,
            "min_value": check.low,
            "max_value": check.high,
            "value_set": list(check.allowed) if check.expectation == IN_SET else None,
            "type_": check.allowed[0] if check.expectation == OF_TYPE else None,
            "type_list": list(check.allowed) if check.expectation == IN_TYPE_LIST else None,
        }
        measured = {name: row[name] for name in RESULT_SCHEMA.names[5:] if row[name] is not None}
        if check.expectation == NON_NULL_SHARE:
            measured["observed_value"] = float(measured["observed_value"])
        if row["position"] in outcome.samples:
            measured["partial_unexpected_list"] = outcome.samples[row["position"]]
        expectations.append(
            {
                "success": row["success"],
                "expectation_config": {
                    "type": check.expectation,
                    "kwargs": {k: v for k, v in arguments.items() if v is not None},
                    "severity": check.severity,
                },
                "result": measured,
            }
        )
    return {"entity": outcome.entity, **about, "success": outcome.success, "expectations": expectations}


def enforce(outcome: Outcome) -> None:
    """Stop the run when a suite failed. Call after the report is saved."""
    if not outcome.success:
        names = ", ".join(f"{row['expectation']}({row['column']})" for row in outcome.failed)
        raise SuiteFailed(f"{outcome.entity}: {names}")


def flatten(checks: Iterable[Check | list[Check]]) -> tuple[Check, ...]:
    """A suite from checks and groups of checks."""
    out: list[Check] = []
    for item in checks:
        out.extend(item if isinstance(item, list) else [item])
    return tuple(out)
