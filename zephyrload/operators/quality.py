"""Expectations, key audits and acceptance checks."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zephyrload.schemas import Contract
from zephyrload.sources.tables import property_of, publish

#: The property of a published table that holds its violations.
VIOLATIONS = "violations"


def expect(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """rows that satisfy every rule; NULL counts as a violation."""
    if not rules:
        return df
    return df.filter(reduce(lambda a, b: a & b, [_holds(rule) for rule in rules.values()]))


def violations(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Q1: one row with the violations per rule, the rows dropped and all rows."""
    return df.agg(*_counts(rules))


def _counts(rules: dict[str, str]) -> list[Column]:
    broken = [~_holds(rule) for rule in rules.values()]
    counts = [F.count(F.when(b, 1)).alias(name) for name, b in zip(rules, broken)]
    dropped = F.count(F.when(reduce(lambda a, b: a | b, broken, F.lit(False)), 1))
    return [*counts, dropped.alias("dropped_rows"), F.count(F.lit(1)).alias("all_rows")]


def publish_expected(
    df: DataFrame, name: str, rules: dict[str, str], comment: str = "", partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """F3 with Q1: publish the rows that satisfy every rule, and the violations beside them.

    The violations are counted by the job that writes, so the source is read once, and are shown in
    the same step as the rows (``kept_violations``). A stage that runs again after a lost executor may count rows
    twice; then the counts do not agree with the rows written, and are taken anew.
    """
    seen = Observation()
    kept = expect(df.observe(seen, *_counts(rules)), rules)

    def properties(written: DataFrame) -> dict[str, str]:
        counts = dict(seen.get)
        if counts["all_rows"] - counts["dropped_rows"] != written.count():
            counts = violations(df, rules).first().asDict()
        return {VIOLATIONS: json.dumps(counts)}

    return publish(kept, name, comment, partition_by, properties)


def kept_violations(spark: SparkSession, name: str) -> dict[str, int]:
    """Q1 of a table as ``publish_expected`` counted it: by rule, dropped_rows and all_rows."""
    return json.loads(property_of(spark, name, VIOLATIONS) or "{}")


def _holds(rule: str):
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """The declared expectations of a table applied to its rows."""
    return expect(df, contract.expectations)


def key_audit(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q2: keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def contract_key_audit(tables: list[tuple[Contract, DataFrame]]) -> DataFrame:
    """Q2 over the declared keys of tables: (table_name, key_values, row_count) of repeated keys.

    Key values are joined by ``|``, a NULL is empty. Tables without a key are passed over.
    """
    audits = [
        key_audit(df, list(contract.key)).select(
            F.lit(contract.name).alias("table_name"),
            F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in contract.key]).alias("key_values"),
            "row_count",
        )
        for contract, df in tables
        if contract.key
    ]
    if not audits:
        return SparkSession.active().createDataFrame([], "table_name string, key_values string, row_count long")
    return reduce(DataFrame.unionByName, audits)


def reference_audit(df: DataFrame, column: str, dim: DataFrame, target: str) -> DataFrame:
    """Q3: codes absent from the dimension, with the rows that carry them.

    Rows are counted per code before the join, so a code borne by most rows
    reaches the join as a single row.
    """
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("orphan_rows")
    )
    return used.join(dim.select(F.col(target).alias(column)), column, "left_anti")


def contract_reference_audit(df: DataFrame, contract: Contract, tables: dict[str, DataFrame]) -> DataFrame:
    """Q3 over all references of a table: (reference, code, orphan_rows)."""
    audits = []
    for reference in contract.references:
        orphans = reference_audit(df, reference.column, tables[reference.table], reference.target)
        audits.append(
            orphans.select(
                F.lit(f"{reference.column} -> {reference.table}").alias("reference"),
                F.col(reference.column).cast("string").alias("code"),
                "orphan_rows",
            )
        )
    if not audits:
        return df.sparkSession.createDataFrame([], "reference string, code string, orphan_rows long")
    return reduce(DataFrame.unionByName, audits)


def acceptance(
    model: DataFrame,
    grain: list[str],
    day: str,
    expected_days: int,
    join_key: str | None = None,
    dim: DataFrame | None = None,
    dim_key: str | None = None,
    overall_marks: tuple[str, ...] = ("OVERALL",),
) -> DataFrame:
    """Q4: (check_name, passed, detail) for a finished model.

    The model is counted once per grain row and code; codes absent from the
    dimension are marked on those counts, so all checks share one pass over it.
    """
    marks = [F.upper(F.col(c).cast("string")).isin(*overall_marks) for c in grain if c != day]
    is_overall = reduce(lambda a, b: a | b, marks) if marks else F.lit(False)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in grain])
    counted = list(dict.fromkeys([*grain, join_key])) if dim is not None else grain
    per_grain = model.groupBy(*counted).agg(F.count(F.lit(1)).alias("_rows"))
    if dim is not None:
        known = dim.select(F.col(dim_key).alias(join_key)).distinct().withColumn("_known", F.lit(True))
        is_orphan = F.col(join_key).isNotNull() & F.col("_known").isNull()
        per_grain = per_grain.join(known, join_key, "left").withColumn("_orphans", F.when(is_orphan, F.col("_rows")))
        if len(counted) > len(grain):
            per_grain = per_grain.groupBy(*grain).agg(F.sum("_rows").alias("_rows"), F.sum("_orphans").alias("_orphans"))
    else:
        per_grain = per_grain.withColumn("_orphans", F.lit(None).cast("bigint"))
    facts = per_grain.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count(F.when(F.col("_rows") > 1, 1)).alias("repeated"),
        F.count(F.when(missing, 1)).alias("missing"),
        F.count(F.when(is_overall, 1)).alias("overall"),
        F.countDistinct(day).alias("days"),
        F.coalesce(F.sum("_orphans"), F.lit(0)).alias("orphans"),
    )
    checks = [
        ("not_empty", F.col("rows") > 0, F.col("rows")),
        ("one_row_per_grain", F.col("repeated") == 0, F.col("repeated")),
        ("grain_known", F.col("missing") == 0, F.col("missing")),
        ("no_overall_row", F.col("overall") == 0, F.col("overall")),
        ("expected_days", F.col("days") == expected_days, F.col("days")),
    ]
    if dim is not None:
        checks.append(("keys_matched", F.col("orphans") == 0, F.col("orphans")))
    return facts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        passed.alias("passed"),
                        detail.cast("bigint").alias("detail"),
                    )
                    for name, passed, detail in checks
                ]
            )
        ).alias("c")
    ).select("c.*")
