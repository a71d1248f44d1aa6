"""Key, reference, domain and limit checks over declared contracts.

Spark does not enforce constraints, so each kind is a job that counts violations.  Keys
that own many rows are counted after map-side combination and references are anti joins
against unique parent keys, so a hot key never meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.keys import group_single_keys
from tradewind.sources.contracts import DOMAINS, Contract, Domain, Field


def _all(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def duplicate_keys(rows: DataFrame, key: Iterable[str]) -> DataFrame:
    """Keys owned by more than one row, with the number of rows."""
    return _rows_per_key(rows, key).where("n > 1")


def _rows_per_key(rows: DataFrame, key: Iterable[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def count_keys(
    rows: DataFrame, key: Iterable[str], deal_by: Iterable[str] | None = None
) -> DataFrame:
    """Every key with the number of its rows, for keys that hardly ever repeat."""
    key = list(key)
    return group_single_keys(
        rows.select(*key), key, lambda part: _rows_per_key(part, key), deal_by
    )


def repeated_keys(
    rows: DataFrame, key: Iterable[str], deal_by: Iterable[str] | None = None
) -> DataFrame:
    """`duplicate_keys` for keys that hardly ever repeat."""
    return count_keys(rows, key, deal_by).where("n > 1")


def _violations(rows: DataFrame, **labels: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("violations")).select(
        *[F.lit(v).alias(k) for k, v in labels.items()], "violations"
    )


def check_primary_keys(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """Per table: keys that repeat or contain NULL."""

    def bad(name: str) -> DataFrame:
        key = contracts[name].key
        return count_keys(tables[name], key).where((F.col("n") > 1) | _any_null(key))

    return _all(_violations(bad(n), table_name=n) for n in tables)


def require_primary_keys(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> None:
    """Stop a load whose primary keys repeat or are missing, as a database would.

    The result collected here has one row per table.
    """
    bad = check_primary_keys(tables, contracts).where("violations > 0").collect()
    if bad:
        listed = ", ".join(f"{r.table_name}: {r.violations}" for r in bad)
        raise ValueError(f"primary keys repeat or are missing ({listed})")


def check_unique(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """Per table and declared natural key: keys that repeat (NULLs do not collide)."""
    parts = []
    for name in tables:
        for key in contracts[name].unique:
            filled = tables[name].where(~_any_null(key))
            parts.append(
                _violations(repeated_keys(filled, key), table_name=name, key=",".join(key))
            )
    return _all(parts)


def orphans(child: DataFrame, parent: DataFrame, columns: Iterable[str], parent_columns) -> DataFrame:
    """Child rows whose filled reference has no parent."""
    columns = list(columns)
    keys = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_columns)])
    return child.join(keys, columns, "left_anti")


def check_foreign_keys(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """Per reference: child rows without a parent; a NULL reference passes."""
    parts = []
    for name in tables:
        for ref in contracts[name].references:
            child = tables[name].select(*ref.columns).where(~_any_null(ref.columns))
            lost = orphans(child, tables[ref.parent], ref.columns, ref.parent_columns)
            parts.append(_violations(lost, table_name=name, reference=ref.parent))
    return _all(parts)


def _unpivot(counts: DataFrame, names: list[str]) -> DataFrame:
    """One aggregate row as (column_name, violations) rows, without a second pass."""
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(n).alias("violations")) for n in names]
    return counts.select(F.explode(F.array(*pairs)).alias("_c")).select("_c.*")


def _count_per_column(
    name: str, rows: DataFrame, tests: Mapping[str, Column]
) -> DataFrame:
    counts = rows.agg(*[F.count_if(bad).alias(column) for column, bad in tests.items()])
    return _unpivot(counts, list(tests)).select(
        F.lit(name).alias("table_name"), "column_name", "violations"
    )


def check_domains(
    tables: Mapping[str, DataFrame], domains: Iterable[Domain] = DOMAINS
) -> DataFrame:
    """Per bounded column: rows outside the bounds, one pass per table; NULL passes."""
    per_table: dict[str, dict[str, Column]] = {}
    for d in domains:
        if d.table not in tables:
            continue
        low = F.col(d.column) < d.low if d.low is not None else F.lit(False)
        high = F.col(d.column) > d.high if d.high is not None else F.lit(False)
        per_table.setdefault(d.table, {})[d.name] = low | high
    return _all(_count_per_column(n, tables[n], tests) for n, tests in per_table.items())


def check_not_null(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """Per NOT NULL column: rows where it is NULL, one pass per table."""
    parts = []
    for name, rows in tables.items():
        present = set(rows.columns)
        required = [f.name for f in contracts[name].fields if f.required and f.name in present]
        if required:
            parts.append(_count_per_column(name, rows, {c: F.col(c).isNull() for c in required}))
    return _all(parts)


def _exceeds(field: Field) -> Column | None:
    value = F.trim(F.col(field.source).cast("string"))
    if field.limit is not None:
        return F.length(value) > field.limit
    if field.type.startswith("decimal"):
        return (F.length(value) > 0) & value.try_cast(field.type).isNull()
    return None


def check_type_bounds(
    raw_tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame:
    """Per limited column of the raw layer: texts too long or numbers that do not fit."""
    parts = []
    for name, rows in raw_tables.items():
        limits = {f.source: _exceeds(f) for f in contracts[name].fields}
        limits = {c: bad for c, bad in limits.items() if bad is not None}
        if limits:
            parts.append(_count_per_column(name, rows, limits))
    return _all(parts)


def check_stored_limits(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> DataFrame | None:
    """Per limited text column of typed tables: texts that are too long, one pass per table.

    Numbers of typed tables fit by their type.  None if no table has such a column.
    """
    parts = []
    for name, rows in tables.items():
        present = set(rows.columns)
        limited = [f for f in contracts[name].fields if f.limit is not None and f.name in present]
        if limited:
            tests = {f.name: F.length(f.name) > f.limit for f in limited}
            parts.append(_count_per_column(name, rows, tests))
    return _all(parts) if parts else None


def require_constraints(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]
) -> None:
    """Stop a load that breaks any declared constraint, as a database would.

    Keys, references, CHECK conditions, NOT NULL columns and lengths of texts; the rows
    collected are one per table and constraint.
    """
    reports = {
        "primary keys": check_primary_keys(tables, contracts),
        "unique keys": check_unique(tables, contracts) if _has_unique(tables, contracts) else None,
        "references": check_foreign_keys(tables, contracts),
        "conditions": check_domains(tables) if any(d.table in tables for d in DOMAINS) else None,
        "mandatory columns": check_not_null(tables, contracts),
        "limits": check_stored_limits(tables, contracts),
    }
    broken = []
    for kind, report in reports.items():
        for row in report.where("violations > 0").collect() if report is not None else []:
            labels = " ".join(str(v) for k, v in row.asDict().items() if k != "violations")
            broken.append(f"{kind}: {labels}: {row.violations}")
    if broken:
        raise ValueError("constraints are broken (" + "; ".join(broken) + ")")


def _has_unique(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> bool:
    return any(contracts[name].unique for name in tables)
