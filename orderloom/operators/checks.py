"""Constraint checks: which rows of a table break which rule of its contract.

Every check returns violations as rows (rule, key, detail). All rules that look at one row are tested in a
single pass; uniqueness and foreign keys first reduce the rows to one per key, so a key that fills a large
part of the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from orderloom.functions import errors
from orderloom.functions.errors import LoadRefused
from orderloom.model import ForeignKey, Table
from orderloom.operators.skew import lookup_join

VIOLATION = "rule STRING, key STRING, detail STRING"


def _key_text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def row_rules(name: str, table: Table, present: Sequence[str]) -> dict[str, Column]:
    """The single-row rules of a contract, for the columns at hand: rule name to "is broken"."""
    rules: dict[str, Column] = {}
    for column in table.required:
        if column in present:
            rules[f"{name}.{column} not null"] = F.col(column).isNull()
    for column, allowed in table.domains.items():
        if column in present:
            rules[f"{name}.{column} domain"] = ~F.col(column).isin(*allowed)
    for column, condition in table.ranges.items():
        if column in present:
            rules[f"{name}.{column} range"] = ~F.expr(condition)
    for column, limit in table.lengths.items():
        if column in present:
            rules[f"{name}.{column} length"] = F.length(column) > limit
    # A comparison with NULL is unknown, and an unknown check passes.
    return {rule: F.coalesce(broken, F.lit(False)) for rule, broken in rules.items()}


def check_rows(df: DataFrame, rules: Mapping[str, Column], key: Sequence[str]) -> DataFrame:
    """Violations of single-row rules, all found in one pass."""
    if not rules:
        return df.sparkSession.createDataFrame([], VIOLATION)
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(rule)) for rule, cond in rules.items()]))
    return (df.select(F.explode(broken).alias("rule"), _key_text(key).alias("key"))
            .withColumn("detail", F.col("rule")).select("rule", "key", "detail"))


def check_not_null(df: DataFrame, column: str, key: Sequence[str]) -> DataFrame:
    return check_rows(df, {f"{column} not null": F.col(column).isNull()}, key)


def check_domain(df: DataFrame, column: str, allowed: Sequence[str], key: Sequence[str]) -> DataFrame:
    broken = F.coalesce(~F.col(column).isin(*allowed), F.lit(False))
    return check_rows(df, {f"{column} domain": broken}, key)


def check_range(df: DataFrame, column: str, condition: str, key: Sequence[str]) -> DataFrame:
    return check_rows(df, {f"{column} range": F.coalesce(~F.expr(condition), F.lit(False))}, key)


def check_length(df: DataFrame, column: str, limit: int, key: Sequence[str]) -> DataFrame:
    return check_rows(df, {f"{column} length": F.coalesce(F.length(column) > limit, F.lit(False))}, key)


def check_unique(df: DataFrame, columns: Sequence[str], rule: str | None = None) -> DataFrame:
    """One violation per key that occurs more than once; two NULLs count as the same key."""
    name = rule or f"{','.join(columns)} unique"
    return (df.groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1")
            .select(F.lit(name).alias("rule"), _key_text(columns).alias("key"),
                    F.concat(F.col("_n").cast("string"), F.lit(" rows")).alias("detail")))


def check_foreign_key(child: DataFrame, columns: Sequence[str], parent: DataFrame,
                      parent_columns: Sequence[str], rule: str | None = None) -> DataFrame:
    """One violation per child key without a parent; a key with a NULL in it passes."""
    name = rule or f"{','.join(columns)} foreign key"
    used = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = child.where(used).groupBy(*columns).agg(F.count("*").alias("_n"))
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    return (keys.join(known, list(columns), "left_anti")
            .select(F.lit(name).alias("rule"), _key_text(columns).alias("key"),
                    F.concat(F.col("_n").cast("string"), F.lit(" rows")).alias("detail")))


def _reference_rule(name: str, fk: ForeignKey) -> str:
    return f"{name}.{','.join(fk.columns)} references {fk.parent}"


def table_violations(name: str, table: Table, df: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """Every violation of a table's contract. References to tables not in ``parents`` are not checked."""
    found = [check_rows(df, row_rules(name, table, df.columns), table.key)]
    for columns in (table.key, *table.unique):
        found.append(check_unique(df, columns, f"{name}.{','.join(columns)} unique"))
    for fk in table.foreign:
        if fk.parent in parents and set(fk.columns) <= set(df.columns):
            found.append(check_foreign_key(df, fk.columns, parents[fk.parent], fk.parent_columns,
                                           _reference_rule(name, fk)))
    return reduce(DataFrame.unionByName, found)


def rule_names(name: str, table: Table, present: Sequence[str], parents: Sequence[str]) -> list[str]:
    """All rules of a contract that ``table_violations`` checks."""
    names = list(row_rules(name, table, present))
    names += [f"{name}.{','.join(columns)} unique" for columns in (table.key, *table.unique)]
    names += [_reference_rule(name, fk) for fk in table.foreign
              if fk.parent in parents and set(fk.columns) <= set(present)]
    return names


class ContractBroken(LoadRefused):
    """Rows break rules of their table's contract: how many per rule."""

    def __init__(self, counts: Mapping[str, int]):
        self.counts = dict(sorted(counts.items()))
        first = next(iter(self.counts))
        kinds = {"not null": errors.NULL_VALUE, "unique": errors.REPEATED_KEY, "length": errors.TEXT_TOO_LONG}
        number = next((n for kind, n in kinds.items() if first.endswith(kind)), errors.CONSTRAINT)
        super().__init__("; ".join(f"{rule}: {n}" for rule, n in self.counts.items()), number)


def watched(name: str, table: Table, df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``df`` with its single-row rules counted while it is written, and a function that gives the counts above zero
    once it is."""
    rules = row_rules(name, table, df.columns)
    if not rules:
        return df, dict
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(broken).alias(f"r{at}") for at, broken in enumerate(rules.values())])
    return counted, lambda: {rule: seen.get[f"r{at}"] for at, rule in enumerate(rules) if seen.get[f"r{at}"]}


def require_contract(name: str, table: Table, df: DataFrame, parents: Mapping[str, DataFrame],
                     broken: Mapping[str, int] | None = None) -> None:
    """Fail with the counts per rule unless the keys of a stored table are unique and all its references are known.

    ``broken`` holds counts of single-row rules, as gathered by ``watched``. References to tables not in ``parents``
    are not checked. Every rule reads its own columns only, and what comes back is one row per broken rule.
    """
    found = [check_unique(df, columns, f"{name}.{','.join(columns)} unique") for columns in (table.key, *table.unique)]
    for fk in table.foreign:
        if fk.parent in parents:
            found.append(check_foreign_key(df, fk.columns, parents[fk.parent], fk.parent_columns,
                                           _reference_rule(name, fk)))
    counts = {r["rule"]: r["n"] for r in reduce(DataFrame.unionByName, found).groupBy("rule").agg(
        F.count("*").alias("n")).collect()}
    counts |= broken or {}
    if counts:
        raise ContractBroken(counts)


def split_valid(name: str, table: Table, df: DataFrame,
                parents: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``df`` as (rows that keep every rule, rows that do not).

    Rejected rows carry the names of the rules they break in ``broken_rules``. Missing parents are found by
    joins that split hot keys; a parent table holds one row per key. All rows of a key that occurs more than once
    are rejected, as none of them is the right one; a key with a NULL in it breaks the rules on NULL instead.
    """
    marked = df
    missing: list[Column] = []
    for at, fk in enumerate(table.foreign):
        if fk.parent not in parents or not set(fk.columns) <= set(df.columns):
            continue
        flag = f"_parent_{at}"
        known = parents[fk.parent].select(
            *[F.col(p).alias(c) for p, c in zip(fk.parent_columns, fk.columns)], F.lit(True).alias(flag))
        marked = lookup_join(marked, known, fk.columns, table.key, "left")
        used = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.columns])
        missing.append(F.when(used & F.col(flag).isNull(), F.lit(_reference_rule(name, fk))))
    for at, columns in enumerate((table.key, *table.unique)):
        if set(columns) <= set(df.columns):
            flag = f"_again_{at}"
            again = df.groupBy(*columns).agg(F.count("*").alias("_n")).where("_n > 1").select(
                *columns, F.lit(True).alias(flag))
            marked = lookup_join(marked, again, list(columns), table.key, "left")
            missing.append(F.when(F.col(flag), F.lit(f"{name}.{','.join(columns)} unique")))
    rules = [F.when(cond, F.lit(rule)) for rule, cond in row_rules(name, table, df.columns).items()]
    marked = marked.select(*df.columns, F.array_compact(F.array(*rules, *missing)).alias("broken_rules"))
    good = marked.where(F.size("broken_rules") == 0).select(*df.columns)
    return good, marked.where(F.size("broken_rules") > 0)
