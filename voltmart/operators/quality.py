"""Rule sets, contracts and their statistics, each in one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from voltmart.functions.keys import false_if_null, split
from voltmart.schemas import CONTRACTS, RULES, Contract, Rule


class ContractError(ValueError):
    """A DataFrame does not have what its contract declares."""


class QualityGateError(RuntimeError):
    """The pass rate is below the critical threshold."""


def _rules(rule_set: str | Sequence[Rule]) -> Sequence[Rule]:
    if not isinstance(rule_set, str):
        return rule_set
    if rule_set not in RULES:
        raise ValueError(f"unknown rule set '{rule_set}', available: {sorted(RULES)}")
    return RULES[rule_set]


def _holds(rule: Rule) -> Column:
    return false_if_null(F.expr(rule.predicate))


def evaluate(df: DataFrame, rule_set: str | Sequence[Rule]) -> DataFrame:
    """One row per rule over the full input: rule, severity, total, passed and failed rows, pass rate."""
    rules = _rules(rule_set)
    counts = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count_if(_holds(r)).alias(f"_p{i}") for i, r in enumerate(rules)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule_name"), F.lit(r.severity).alias("severity"),
                F.col(f"_p{i}").alias("passed_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select("total_rows", F.inline(lines)).select(
        "rule_name", "severity", "total_rows", "passed_rows",
        (F.col("total_rows") - F.col("passed_rows")).alias("failed_rows"),
        pass_rate("passed_rows", "total_rows").alias("pass_rate"),
    )


def pass_rate(passed: str, total: str) -> Column:
    return F.when(F.col(total) == 0, F.lit(1.0)).otherwise(F.col(passed) / F.col(total))


def tag_failures(df: DataFrame, rule_set: str | Sequence[Rule], all_rules: bool = False) -> DataFrame:
    """Add ``_failed_rule``: the first CRITICAL rule (or any rule) the row fails, NULL if none."""
    filtering = [r for r in _rules(rule_set) if all_rules or r.severity == "CRITICAL"]
    failed = F.coalesce(*[F.when(~_holds(r), F.lit(r.name)) for r in filtering], F.lit(None).cast("string"))
    return df.withColumn("_failed_rule", failed)


def enforce(df: DataFrame, rule_set: str | Sequence[Rule]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, failed tagged with the first failing CRITICAL rule, per-rule counts)."""
    failed, valid = split(tag_failures(df, rule_set), F.col("_failed_rule").isNotNull())
    return valid.drop("_failed_rule"), failed, evaluate(df, rule_set)


@dataclass(frozen=True)
class Routed:
    """What ``route`` wrote, and what it counted while writing."""

    valid: DataFrame
    quarantined: DataFrame
    counts: DataFrame
    null_keys: dict[str, int]


def route(
    df: DataFrame, rule_set: str | Sequence[Rule], path: str, contract: str | Contract | None = None, critical: float = 0.0
) -> Routed:
    """Check a batch and write it once, by verdict: one scan of the source for counts, valid and quarantined rows.

    Rows are tagged with the first CRITICAL rule they fail and appended under ``path/verdict=valid`` or ``=quarantined``;
    rule counts and NULL keys of the contract are observed in the same job. Missing columns raise before anything is
    written. NULL keys, or a share of valid rows below ``critical``, raise afterwards: the rows are then in the table, so a
    caller passes a new path per batch and publishes it on return.
    """
    rules = _rules(rule_set)
    keys = list(contract_of(contract).keys) if contract is not None else []
    if contract is not None:
        require_columns(df, contract)
    seen = Observation()
    tagged = tag_failures(df, rules).observe(
        seen, F.count("*").alias("total"), F.count_if(F.col("_failed_rule").isNull()).alias("valid"),
        *[F.count_if(_holds(r)).alias(f"_p{i}") for i, r in enumerate(rules)],
        *[F.count_if(F.col(k).isNull()).alias(f"_k{i}") for i, k in enumerate(keys)],
    )
    verdict = F.when(F.col("_failed_rule").isNull(), "valid").otherwise("quarantined")
    tagged.withColumn("verdict", verdict).write.mode("append").partitionBy("verdict").parquet(path)
    spark, got = df.sparkSession, seen.get
    lines = [
        (r.name, r.severity, got["total"], got[f"_p{i}"], got["total"] - got[f"_p{i}"],
         got[f"_p{i}"] / got["total"] if got["total"] else 1.0)
        for i, r in enumerate(rules)
    ]
    counts = spark.createDataFrame(
        lines, "rule_name string, severity string, total_rows long, passed_rows long, failed_rows long, pass_rate double"
    )
    nulls = {k: got[f"_k{i}"] for i, k in enumerate(keys)}
    if any(nulls.values()):
        raise ContractError(f"NULL keys: { {k: n for k, n in nulls.items() if n} }")
    if got["total"] and got["valid"] / got["total"] < critical:
        raise QualityGateError(f"share of valid rows {got['valid'] / got['total']:.2%} below {critical:.0%}")
    fields = T.StructType([*tagged.schema.fields, T.StructField("verdict", T.StringType())])
    stored = spark.read.schema(fields).parquet(path)
    return Routed(
        stored.filter("verdict = 'valid'").drop("_failed_rule", "verdict"),
        stored.filter("verdict = 'quarantined'").drop("verdict"), counts, nulls,
    )


def rule_set_stats(df: DataFrame, rule_set: str, target_table: str, run_id: str) -> DataFrame:
    """One statistics row for the whole rule set, every rule filtering."""
    tagged = tag_failures(df, rule_set, all_rules=True)
    return tagged.agg(
        F.count("*").alias("total_rows"), F.count_if(F.col("_failed_rule").isNull()).alias("passed_rows")
    ).select(
        F.lit(run_id).alias("run_id"),
        F.lit(rule_set).alias("rule_set_name"),
        F.lit(target_table).alias("target_table"),
        "total_rows",
        "passed_rows",
        (F.col("total_rows") - F.col("passed_rows")).alias("failed_rows"),
        pass_rate("passed_rows", "total_rows").alias("pass_rate"),
        F.current_timestamp().alias("validated_at"),
    )


def gate_status(rate: Column, critical: float = 0.80, warn: float = 0.95) -> Column:
    return F.when(rate < critical, "CRITICAL").when(rate < warn, "WARNING").otherwise("OK")


def validate(
    df: DataFrame, rule_set: str, target_table: str, run_id: str, critical: float = 0.80
) -> tuple[DataFrame, DataFrame]:
    """(rows passing every rule, statistics row). Runs one aggregation and raises below ``critical``."""
    stats = rule_set_stats(df, rule_set, target_table, run_id)
    rate = stats.first()["pass_rate"]
    if rate < critical:
        raise QualityGateError(f"{rule_set}: pass rate {rate:.2%} below {critical:.0%} on {target_table}")
    clean, _ = split(tag_failures(df, rule_set, all_rules=True), F.col("_failed_rule").isNull())
    return clean.drop("_failed_rule"), stats


def dq_stats(df: DataFrame, rule_set: str, target_table: str, run_id: str) -> DataFrame:
    """Per-rule statistics rows ready to append."""
    return evaluate(df, rule_set).withColumns(
        {
            "run_id": F.lit(run_id),
            "rule_set_name": F.lit(rule_set),
            "target_table": F.lit(target_table),
            "validated_at": F.current_timestamp(),
        }
    )


def expect_non_negative(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    return split(df, F.col(column) >= 0)


def expect_not_null(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    return split(df, F.col(column).isNotNull())


def contract_of(contract: str | Contract) -> Contract:
    if isinstance(contract, Contract):
        return contract
    if contract not in CONTRACTS:
        raise ContractError(f"no contract '{contract}'")
    return CONTRACTS[contract]


def missing_columns(df: DataFrame, contract: str | Contract) -> list[str]:
    return sorted(set(contract_of(contract).schema.names) - set(df.columns))


def require_columns(df: DataFrame, contract: str | Contract) -> DataFrame:
    missing = missing_columns(df, contract)
    if missing:
        raise ContractError(f"missing columns: {missing}")
    return df


def key_violations(df: DataFrame, contract: str | Contract) -> DataFrame:
    """One row per key column with its number of NULLs; a key column that is absent raises."""
    keys = contract_of(contract).keys
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ContractError(f"missing key columns: {absent}")
    counts = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])
    lines = F.array(*[F.struct(F.lit(k).alias("key_column"), F.col(k).alias("null_rows")) for k in keys])
    return counts.select(F.inline(lines))


def validate_contract(df: DataFrame, contract: str | Contract) -> DataFrame:
    """Columns and keys; raises on a violation, else returns ``df``."""
    require_columns(df, contract)
    bad = {r["key_column"]: r["null_rows"] for r in key_violations(df, contract).collect() if r["null_rows"]}
    if bad:
        raise ContractError(f"NULL keys: {bad}")
    return df


def _accepts(declared: T.DataType, actual: T.DataType) -> bool:
    if isinstance(declared, T.DoubleType):
        return isinstance(actual, T.NumericType)
    if isinstance(declared, (T.IntegerType, T.LongType)):
        return isinstance(actual, T.IntegralType)
    return isinstance(actual, type(declared))


def contract_violations(
    df: DataFrame, contract: str | Contract, order: str, strict: bool = True
) -> DataFrame:
    """One row per broken (field, problem): row count and the first offending row by ``order``.

    ``strict`` counts every value of a wrongly typed column; otherwise only values that cannot be cast.
    """
    checks: list[tuple[str, str, Column]] = []
    for field in contract_of(contract).schema:
        if field.name not in df.columns:
            continue
        value = F.col(field.name)
        if not field.nullable:
            checks.append((field.name, "null", value.isNull()))
        if not _accepts(field.dataType, df.schema[field.name].dataType):
            wrong = value.isNotNull() if strict else (
                value.isNotNull() & value.try_cast(field.dataType).isNull()
            )
            checks.append((field.name, "type", wrong))
    if not checks:
        checks = [("", "none", F.lit(False))]
    counts = df.agg(
        *[F.count_if(c).alias(f"_n{i}") for i, (_, _, c) in enumerate(checks)],
        *[F.min(F.when(c, F.col(order))).alias(f"_f{i}") for i, (_, _, c) in enumerate(checks)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("field_name"), F.lit(problem).alias("problem"),
                F.col(f"_n{i}").alias("row_count"), F.col(f"_f{i}").alias("first_row"),
            )
            for i, (name, problem, _) in enumerate(checks)
        ]
    )
    return counts.select(F.inline(lines)).filter(F.col("row_count") > 0)
