"""Data-quality report (Q1–Q6), driven by the schema registry.

Q1–Q5 are one aggregation per table (null counts for all columns in a
single pass, duplicate key groups via a map-side combined group-by) or one
anti join; Q6 reads every table once and counts all keys and references in
one grouped count.  The results are small DataFrames, never collected row by
row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions.exprs import pct, r2
from souk.sources.schemas import DATE_RANGE_CHECKS, KEY_CHECKS, LOAD_ORDER, TABLES


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def null_percent(wh, tables: list[str] | None = None) -> DataFrame:
    """Q2: (table_name, column_name, null_pct) for columns with any NULL; empty tables skipped."""
    parts = []
    for t in tables or LOAD_ORDER:
        df = wh[t]
        cols = df.columns
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]
        )
        long = counts.unpivot("_rows", cols, "column_name", "_nulls")
        parts.append(
            long.where(F.col("_rows") > 0).select(
                F.lit(t).alias("table_name"),
                "column_name",
                r2(pct("_nulls", "_rows"), 1).alias("null_pct"),
            )
        )
    return _union(parts).where(F.col("null_pct") > 0).orderBy("table_name", "column_name")


def duplicate_key_groups(wh, keys: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Q3: number of key values that occur more than once, per keyed table; empty tables skipped."""
    parts = []
    for t, key in (keys or KEY_CHECKS).items():
        groups = wh[t].groupBy(*key).count()
        counted = groups.agg(F.count(F.lit(1)).alias("_groups"), F.count_if(F.col("count") > 1).alias("duplicate_groups"))
        parts.append(
            counted.where(F.col("_groups") > 0).select(
                F.lit(t).alias("table_name"), F.lit(", ".join(key)).alias("key_columns"), "duplicate_groups"
            )
        )
    return _union(parts).orderBy("table_name")


def date_ranges(wh, checks: dict[str, str] | None = None) -> DataFrame:
    """Q4: first and last value of the date column of each checked table; empty tables skipped."""
    parts = [
        wh[t].agg(F.count(F.lit(1)).alias("_rows"), F.min(c).alias("min_value"), F.max(c).alias("max_value")).where(F.col("_rows") > 0).select(
            F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), "min_value", "max_value"
        )
        for t, c in (checks or DATE_RANGE_CHECKS).items()
    ]
    return _union(parts).orderBy("table_name")


def orphan_orders(wh) -> DataFrame:
    """Q5: orders whose customer_id has no customer row."""
    per_customer = wh["orders"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("_rows"))
    return per_customer.join(wh["customers"].select("customer_id"), "customer_id", "left_anti").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).cast("long").alias("orphan_orders")
    )


def _key_types(df: DataFrame, cols: tuple[str, ...]) -> tuple[T.DataType, ...]:
    return tuple(df.schema[c].dataType for c in cols)


def declared_constraints(wh) -> DataFrame:
    """Q6: violations of every declared constraint.

    (table_name, check_type, columns, violations): PRIMARY KEY -> duplicate
    key groups plus rows with a NULL key part; NOT NULL -> NULL rows;
    FOREIGN KEY -> rows whose non-NULL reference has no target row.

    Every table is read once.  A row gives its own key and its references,
    each to the key set it belongs to, and a mark per violation it shows by
    itself (a NULL).  One grouped count per (set, key), map-side combined,
    then tells the keys that occur twice and the references without a target.
    """
    marks: dict[str, list[tuple[Column, int]]] = {t: [] for t in LOAD_ORDER}  # numbered below zero
    members: dict[str, list[tuple[int, int, tuple[str, ...]]]] = {t: [] for t in LOAD_ORDER}
    sets: dict[tuple, int] = {}
    references: dict[int, int] = {}  # per set, how many foreign keys point to it
    report: list[tuple[str, str, str, int, int]] = []  # a check and where its violations are counted

    def mark(t: str, condition: Column, check_type: str, columns: str) -> None:
        number = -1 - sum(map(len, marks.values()))
        marks[t].append((condition, number))
        report.append((t, check_type, columns, number, 0))

    def key_set(t: str, cols: tuple[str, ...], types: tuple[T.DataType, ...]) -> int:
        if (t, cols, types) not in sets:
            sets[t, cols, types] = number = len(sets)
            references[number] = 0
            members[t].append((number, 0, cols))
        return sets[t, cols, types]

    for t in LOAD_ORDER:
        spec, df = TABLES[t], wh[t]
        for c in spec.not_null:
            if c in df.columns:
                mark(t, F.col(c).isNull(), "NOT NULL", c)
        if spec.primary_key:
            label = ", ".join(spec.key)
            mark(t, reduce(Column.__or__, [F.col(k).isNull() for k in spec.key]), "PRIMARY KEY", label)
            report.append((t, "PRIMARY KEY", label, key_set(t, spec.key, _key_types(df, spec.key)), 0))
        for cols, target, tcols in spec.foreign_keys:
            types = _key_types(wh[target], tcols)
            if types != _key_types(df, cols):  # compared in their common type, as a join does
                both = wh[target].select(*tcols).union(df.select(*cols))
                types = _key_types(both, tcols)
            number = key_set(target, tcols, types)
            references[number] += 1
            members[t].append((number, references[number], cols))
            report.append((t, "FOREIGN KEY", f"{', '.join(cols)} -> {target}({', '.join(tcols)})", number, references[number]))

    # one key column per position and type, shared by the sets
    types_of = {number: types for (_, _, types), number in sets.items()}
    slots = {(i, x.simpleString()): x for types in types_of.values() for i, x in enumerate(types)}
    names = {slot: f"_key{slot[0]}_{n}" for n, slot in enumerate(slots)}

    def entry(number: int, reference: int, cols: tuple[str, ...] = ()) -> Column:
        filled = {(i, x.simpleString()): F.col(c) for i, (c, x) in enumerate(zip(cols, types_of.get(number, ())))}
        keys = [filled.get(slot, F.lit(None)).cast(x).alias(names[slot]) for slot, x in slots.items()]
        return F.struct(F.lit(number).alias("_set"), F.lit(reference).alias("_reference"), *keys)

    parts = []
    for t in LOAD_ORDER:
        keys = [
            F.when(reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]), entry(number, reference, cols))
            for number, reference, cols in members[t]
        ]
        seen = [F.when(condition, entry(number, 0)) for condition, number in marks[t]]
        if keys and seen:  # most rows have nothing to mark
            marked = reduce(Column.__or__, [condition for condition, _ in marks[t]])
            entries = F.when(marked, F.array(*keys, *seen)).otherwise(F.array(*keys))
        elif keys or seen:
            entries = F.array(*keys, *seen)
        else:
            continue
        parts.append(wh[t].select(F.explode(entries).alias("_entry")).where(F.col("_entry").isNotNull()).select("_entry.*"))

    width = 1 + max(references.values(), default=0)
    per_key = _union(parts).groupBy("_set", *names.values()).agg(
        *[F.count_if(F.col("_reference") == r).alias(f"_rows{r}") for r in range(width)]
    )
    own = F.when(F.col("_set") < 0, F.col("_rows0")).otherwise((F.col("_rows0") > 1).cast("long"))
    orphans = [F.when(F.col("_rows0") == 0, F.col(f"_rows{r}")).otherwise(F.lit(0)) for r in range(1, width)]
    counted = per_key.groupBy("_set").agg(F.array(*[F.sum(v) for v in (own, *orphans)]).alias("_counts")).select(
        "_set", F.posexplode("_counts").alias("_reference", "_violations")
    )
    labels = ("table_name", "check_type", "columns")
    declared = wh[LOAD_ORDER[0]].sparkSession.range(1).select(
        F.inline(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip((*labels, "_set", "_reference"), r)]) for r in report]))
    )
    # a row per set and reference at most
    return (
        declared.join(F.broadcast(counted), ["_set", "_reference"], "left")
        .groupBy(*labels)
        .agg(F.coalesce(F.sum("_violations"), F.lit(0)).cast("long").alias("violations"))
        .orderBy(*labels)
    )


class ConstraintViolation(Exception):
    pass


def enforce_constraints(wh) -> DataFrame:
    """Strict load: raise if any declared constraint is violated (what the warehouse DDL does)."""
    report = declared_constraints(wh)
    bad = report.where(F.col("violations") > 0).collect()  # one row per declared constraint at most
    if bad:
        lines = [f"{r.table_name} {r.check_type} ({r.columns}): {r.violations}" for r in bad]
        raise ConstraintViolation("constraint violations:\n" + "\n".join(lines))
    return report
