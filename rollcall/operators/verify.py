"""Contracts and declared table tests, each evaluated in as few passes as the rules allow."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.sources.contracts import Contract, Field


class ContractBroken(ValueError):
    pass


def _strays(values: Column, allowed) -> Column:
    """Rows outside a closed domain; nulls pass."""
    return F.count_if(F.coalesce(~values.isin(*allowed), F.lit(False)))


def field_rules(f: Field) -> dict[str, Column]:
    raw = F.col(f.name)
    typed = raw.try_cast(f.type)
    rules = {"type": F.count_if(typed.isNull() & raw.isNotNull())}
    if not f.nullable:
        rules["not_null"] = F.count_if(raw.isNull())
    if f.domain:
        rules["domain"] = _strays(typed, f.domain)
    low = None
    if f.above is not None:
        low = typed > f.above
    elif f.at_least is not None:
        low = typed >= f.at_least
    if f.at_most is not None:
        low = low & (typed <= f.at_most)
    if low is not None:
        rules["range"] = F.count_if(F.coalesce(~low, F.lit(False)))
    return rules


def contract_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """(feed, column, rule, violations), every rule of the feed, broken or not.

    Column rules share one aggregation over the feed; the grain is one more, keyed by the
    grain. Missing and extra columns come from the schema and cost nothing.
    """
    present = set(df.columns)
    counters = [
        (f.name, rule, n)
        for f in contract.fields
        if f.name in present
        for rule, n in field_rules(f).items()
    ]
    missing = [f.name for f in contract.fields if f.name not in present]
    extra = [c for c in df.columns if c not in contract.by_name]
    counters += [(c, "missing", F.lit(1).cast("bigint")) for c in missing]
    counters += [(c, "unexpected", F.lit(1).cast("bigint")) for c in extra]
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), n.alias("violations"))
        for c, rule, n in counters
    ]
    feed = F.lit(contract.feed).alias("feed")
    out = df.agg(F.array(*entries).alias("entries")).select(feed, F.inline("entries"))
    if contract.grain and set(contract.grain) <= present:
        out = out.unionByName(
            duplicate_keys(df, contract.grain)
            .agg(F.count(F.lit(1)).alias("violations"))
            .select(
                feed,
                F.lit("+".join(contract.grain)).alias("column"),
                F.lit("unique").alias("rule"),
                "violations",
            )
        )
    return out


def partition_report(df: DataFrame, contract: Contract, partition: Column) -> DataFrame:
    """(partition, rows, violations): every rule of the contract, counted where its rows lie.

    Column rules and row counts share one aggregation keyed by the partition; the grain is one more. A column that is
    missing counts once in each partition, an unexpected one once in each that fills it.
    """
    present = set(df.columns)
    rules = [n for f in contract.fields if f.name in present for n in field_rules(f).values()]
    rules += [F.lit(1).cast("bigint") for f in contract.fields if f.name not in present]
    rules += [(F.count(F.col(c)) > 0).cast("bigint") for c in df.columns if c not in contract.by_name]
    placed = df.withColumn("_partition", partition)
    out = placed.groupBy("_partition").agg(F.count(F.lit(1)).alias("rows"), sum(rules).alias("violations"))
    if contract.grain and set(contract.grain) <= present:
        repeated = duplicate_keys(placed, ["_partition", *contract.grain]).groupBy("_partition")
        out = out.join(repeated.agg(F.count(F.lit(1)).alias("_repeated")), "_partition", "left").withColumn(
            "violations", F.col("violations") + F.coalesce("_repeated", F.lit(0))
        )
    return out.select(F.col("_partition").alias("partition"), "rows", "violations")


def require(violations: DataFrame) -> None:
    """Stop on a broken contract, naming every broken rule (the frame has a few dozen rows)."""
    broken = violations.where("violations > 0").collect()
    if broken:
        raise ContractBroken(
            "; ".join(f"{r['feed']}.{r['column']} {r['rule']}: {r['violations']}" for r in broken)
        )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple], ...] = ()
    # (column, referenced table, referenced column)
    refers: tuple[tuple[str, str, str], ...] = ()


def table_test_results(
    tables: Mapping[str, DataFrame], declared: Mapping[str, TableTests]
) -> DataFrame:
    """(table, column, test, violations) for every declared test."""
    parts = []
    for name, tests in declared.items():
        df = tables[name]
        counters = [(c, "not_null", F.count_if(F.col(c).isNull())) for c in tests.not_null]
        counters += [
            (c, "accepted_values", _strays(F.col(c), values)) for c, values in tests.accepted
        ]
        if counters:
            entries = [
                F.struct(F.lit(c).alias("column"), F.lit(t).alias("test"), n.alias("violations"))
                for c, t, n in counters
            ]
            parts.append(
                df.agg(F.array(*entries).alias("entries")).select(
                    F.lit(name).alias("table"), F.inline("entries")
                )
            )
        for c in tests.unique:
            repeated = duplicate_keys(df.where(F.col(c).isNotNull()), [c])
            parts.append(_counted(repeated, name, c, "unique"))
        for c, other, key in tests.refers:
            orphans = orphan_keys(df, c, tables[other], key)
            parts.append(_counted(orphans, name, c, "relationships", F.sum("rows")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def orphan_keys(
    df: DataFrame, column: str, other: DataFrame, key: str, nulls_too: bool = False
) -> DataFrame:
    """Foreign keys without a parent and their row counts; a null key counts only on request.

    Keys are counted first, so the join sees one row per key however many rows carry it.
    """
    rows = df if nulls_too else df.where(F.col(column).isNotNull())
    used = rows.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(other.select(F.col(key).alias("key")), "key", "left_anti")


def _counted(df: DataFrame, table: str, column: str, test: str, count=None) -> DataFrame:
    count = F.count(F.lit(1)) if count is None else F.coalesce(count, F.lit(0))
    return df.agg(count.alias("violations")).select(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(test).alias("test"),
        "violations",
    )
