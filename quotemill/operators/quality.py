"""Declarative data checks.

A check counts the violations of one rule; any violation makes an error-level check
``fail`` and a warning-level check ``warn``. The report is itself a DataFrame, one row
per check. All not-null and accepted-values checks of a table share one aggregate, or none
if the counts were taken while the table was written. The violating rows themselves are
listed by ``violations``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill import schemas as S
from quotemill.operators.prices import merged_days

ERROR, WARN = "error", "warn"
#: Rules that look at one row at a time.
ROW_RULES = ("not_null", "accepted_values")


@dataclass(frozen=True)
class Check:
    table: str
    columns: tuple[str, ...]
    rule: str
    severity: str = ERROR
    values: tuple[str, ...] = field(default=())
    parent: tuple[str, str] | None = None


class QualityError(RuntimeError):
    """An error-level check found violations."""


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, (name,), "not_null") for name in columns]


def unique(table: str, *columns: str, severity: str = ERROR) -> Check:
    return Check(table, columns, "unique", severity)


def accepted_values(
    table: str, column: str, values: Iterable[str], severity: str = ERROR
) -> Check:
    return Check(table, (column,), "accepted_values", severity, values=tuple(values))


def relationship(
    table: str, column: str, parent: str, parent_column: str, severity: str = ERROR
) -> Check:
    return Check(table, (column,), "relationships", severity, parent=(parent, parent_column))


# --- fixed values: the checks of the published model ---------------------------------
MODEL_CHECKS = (
    *not_null("stg_daily_prices", "symbol", "trade_date", "close"),
    accepted_values(
        "stg_daily_prices",
        "market_category",
        (*S.COMPANY_CATEGORY_LABELS.values(), S.OTHER_CATEGORY),
        WARN,
    ),
    *not_null("stg_symbols_meta", "symbol", "market_category"),
    unique("stg_symbols_meta", "symbol"),
    *not_null("dim_companies", "symbol", "security_name", "market_category"),
    unique("dim_companies", "symbol"),
    *not_null("fact_daily_prices", "symbol", "trade_date", "close", "volume"),
    relationship("fact_daily_prices", "symbol", "dim_companies", "symbol", WARN),
    *not_null("agg_sector_performance", "trade_month", "market_category", "ticker_count"),
    *not_null("agg_monthly_summary", "trade_month", "avg_close", "total_volume"),
    unique("agg_monthly_summary", "trade_month"),
    *not_null("agg_yearly_performance", "trade_year", "market_category", "avg_daily_return"),
    *not_null("agg_market_crash_analysis", "event_name", "avg_volatility"),
    unique("agg_market_crash_analysis", "event_name"),
    *not_null("agg_top_tickers_alltime", "symbol", "avg_daily_return", "trading_days"),
    unique("agg_top_tickers_alltime", "symbol"),
)

# The documented key of the fact, which the published checks leave out.
FACT_KEY_CHECK = unique("fact_daily_prices", "symbol", "trade_date", severity=WARN)


def _row(check: Check, failures: Column) -> Column:
    failures = failures.cast("bigint")
    verdict = "fail" if check.severity == ERROR else "warn"
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(", ".join(check.columns)).alias("column_name"),
        F.lit(check.rule).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        failures.alias("failures"),
        F.when(failures > 0, verdict).otherwise("pass").alias("status"),
    )


def _violated(check: Check) -> Column:
    """Whether a row violates a rule that looks at one row at a time."""
    column = F.col(check.columns[0])
    if check.rule == "not_null":
        return column.isNull()
    return ~column.isin(*check.values)  # NULL is accepted


def measure_name(check: Check) -> str:
    return f"{check.table} {check.columns[0]} {check.rule}"


def row_measures(checks: Iterable[Check], *tables: str) -> dict[str, Column]:
    """Counts of violations of the row-level rules of some tables, as aggregates by name.

    For the writer of a table, which takes them in its own pass. A table of the same rows
    and columns, such as a view that is written, can be measured with it.
    """
    return {
        measure_name(check): F.count_if(_violated(check))
        for check in checks
        if check.rule in ROW_RULES and check.table in tables
    }


def _row_level(table: DataFrame, checks: list[Check]) -> DataFrame:
    """All rules that look at one row at a time, in one pass over the table."""
    violated = [F.count_if(_violated(check)) for check in checks]
    counts = table.agg(*(count.alias(f"c{i}") for i, count in enumerate(violated)))
    rows = F.array(*(_row(check, F.col(f"c{i}")) for i, check in enumerate(checks)))
    return counts.select(F.inline(rows))


def duplicated_keys(table: DataFrame, *columns: str) -> DataFrame:
    """Non-null keys that occur more than once."""
    present = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in columns))
    return (
        table.where(present)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null keys of ``child`` missing in ``parent``, with their row counts.

    Rows are counted per key before the anti join, so the join handles keys only.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column)
    known = parent.select(F.col(parent_column).alias(column))
    return keys.agg(F.count(F.lit(1)).alias("rows")).join(known, column, "left_anti")


def _table_level(
    tables: Mapping[str, DataFrame], check: Check, months: Mapping[str, DataFrame]
) -> DataFrame:
    table = tables[check.table]
    if check.rule == "relationships":
        parent, parent_column = check.parent
        found = orphans(table, check.columns[0], tables[parent], parent_column)
        failures = F.sum("rows")
    elif check.table in months and set(check.columns) == {"symbol", "trade_date"}:
        found = merged_days(months[check.table].where("symbol IS NOT NULL"))
        failures = F.sum(F.bit_count("days_twice"))
    else:
        found = duplicated_keys(table, *check.columns)
        failures = F.count(F.lit(1))
    counted = found.agg(F.coalesce(failures, F.lit(0)).alias("n"))
    return counted.select(F.inline(F.array(_row(check, F.col("n")))))


def quality_report(
    tables: Mapping[str, DataFrame],
    checks: Iterable[Check] = MODEL_CHECKS,
    *,
    measured: Mapping[str, int] | None = None,
    months: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per check: table, column, rule, severity, violations, status.

    Meant for written tables, since each table is scanned once for its row-level
    rules and once per other rule. ``measured`` has the counts of row-level rules that are
    known from the writes (``row_measures``); these tables are not scanned for them.
    ``months`` has the ticker-month rollup of tables of prices: their key, symbol and date,
    is checked on its days, without a shuffle of the table.
    """
    checks, measured, months = list(checks), measured or {}, months or {}
    by_row = [c for c in checks if c.rule in ROW_RULES]
    known = [c for c in by_row if measure_name(c) in measured]
    by_table = sorted((c for c in by_row if measure_name(c) not in measured), key=lambda c: c.table)
    parts = []
    if known:
        spark = next(iter(tables.values())).sparkSession
        told = F.array(*(_row(check, F.lit(measured[measure_name(check)])) for check in known))
        parts.append(spark.range(1).select(F.inline(told)))
    parts += [
        _row_level(tables[name], list(group))
        for name, group in groupby(by_table, key=lambda c: c.table)
    ]
    parts += [_table_level(tables, c, months) for c in checks if c.rule not in ROW_RULES]
    return reduce(DataFrame.unionByName, parts)


def violations(
    tables: Mapping[str, DataFrame],
    checks: Iterable[Check],
    keys: Mapping[str, Sequence[str]] = S.TABLE_KEYS,
) -> DataFrame:
    """The rows behind the counts of ``quality_report``: which rule, which key, which value.

    ``table_name``, ``column_name``, ``check_name`` and ``severity`` name the check. ``key``
    is a map from the key columns of the table (``keys``) to their values as text; a table
    that is not in ``keys`` is named by all its columns. ``value`` is the value of the column
    that violates the rule.

    A not-null, accepted-values or relationships check has a row for each violating row, a
    unique check one for each repeated key, with its occurrences as the value. All rules of
    a table that look at one row are tagged in one pass, and only rows with a tag are
    exploded. Of a relationship, the child's keys are reduced before they meet the parent's.
    """
    checks = list(checks)
    by_row = sorted((c for c in checks if c.rule in ROW_RULES), key=lambda c: c.table)
    parts = [
        _tagged(tables[name], list(group), keys.get(name, tables[name].columns))
        for name, group in groupby(by_row, key=lambda c: c.table)
    ]
    for check in checks:
        table = tables[check.table]
        key = keys.get(check.table, table.columns)
        if check.rule == "unique":
            found = duplicated_keys(table, *check.columns)
            parts.append(found.select(_violation(check, check.columns, F.col("occurrences"))))
        elif check.rule == "relationships":
            (column,), (parent, parent_column) = check.columns, check.parent
            lost = orphans(table, column, tables[parent], parent_column).select(column)
            found = table.join(lost, column, "left_semi")
            parts.append(found.select(_violation(check, key, F.col(column))))
    return reduce(DataFrame.unionByName, [part.select("violation.*") for part in parts])


def _violation(check: Check, key: Sequence[str], value: Column) -> Column:
    entries = [part for name in key for part in (F.lit(name), F.col(name).cast("string"))]
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(", ".join(check.columns)).alias("column_name"),
        F.lit(check.rule).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        F.create_map(*entries).alias("key"),
        value.cast("string").alias("value"),
    ).alias("violation")


def _tagged(table: DataFrame, checks: list[Check], key: Sequence[str]) -> DataFrame:
    """Violations of the row-level rules of a table, from one pass."""
    tags = F.array(*(F.when(_violated(check), F.lit(number)) for number, check in enumerate(checks)))
    marked = table.withColumn("violated", F.array_compact(tags)).where(F.size("violated") > 0)
    single = marked.withColumn("violated", F.explode("violated"))
    told = F.lit(None)
    for number, check in enumerate(checks):
        told = F.when(F.col("violated") == number, _violation(check, key, F.col(check.columns[0]))).otherwise(told)
    return single.select(told.alias("violation"))


def enforce(report: DataFrame) -> list:
    """Rows of the report; raises if an error-level check failed.

    The report has one row per declared check, so it is small by construction.
    """
    rows = report.orderBy("table_name", "column_name", "check_name").collect()
    failed = [row for row in rows if row.status == "fail"]
    if failed:
        names = (f"{row.table_name}.{row.column_name} {row.check_name}" for row in failed)
        raise QualityError("failed checks: " + "; ".join(names))
    return rows
