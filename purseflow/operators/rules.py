"""Row rules: a code and the condition that breaks it, applied in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as fn
from ..session import stage
from ..sources.tables import CATEGORIES, STATUSES
from .joins import join_group_stats

# Id patterns (numbers that outgrow their width keep all digits), amount bounds and the quality gate of the data contract.
TXN_PATTERN = r"^TXN\d{8,}$"
USER_PATTERN = r"^U\d{4,}$"
MIN_AMOUNT, MAX_AMOUNT = 1, 1_000_000
PROCESS_MAX_AMOUNT = 500_000
GATE_PERCENT = 90
STRICT = "decimal(38,10)"


class Rule(NamedTuple):
    code: Column
    broken: Column


def rule(code: str | Column, broken: Column) -> Rule:
    """NULL never breaks a rule by accident: an undecided condition counts as broken."""
    return Rule(F.lit(code) if isinstance(code, str) else code, F.coalesce(broken, F.lit(True)))


def errors(rules: Sequence[Rule]) -> Column:
    """The codes of all broken rules, in rule order."""
    return F.array_compact(F.array(*[F.when(r.broken, r.code) for r in rules]))


def check(df: DataFrame, rules: Sequence[Rule], out: str = "errors") -> DataFrame:
    return df.withColumn(out, errors(rules))


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows with their errors; the rules run once."""
    checked = stage(check(df, rules), "checked")
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    good = F.count_if(F.size("errors") == 0)
    return check(df, rules).agg(
        F.count("*").alias("total"),
        good.alias("valid"),
        F.count_if(F.size("errors") > 0).alias("invalid"),
        F.coalesce(fn.percent(good, F.count("*")), F.lit(0.0)).alias("valid_pct"),
    )


def histogram(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows per broken rule."""
    return (
        check(df, rules)
        .select(F.explode("errors").alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("n_rows"))
    )


def strict_amount(col: Column) -> Column:
    """The text as a number, NULL when it is none."""
    return col.try_cast(STRICT)


def in_range(value: Column, low: int, high: int) -> Column:
    return value.between(F.lit(low).cast(STRICT), F.lit(high).cast(STRICT))


def shown_label(name: str) -> Column:
    """A label inside a message; a missing one must not make the message vanish."""
    return F.coalesce(F.col(name), F.lit(""))


def validator_rules() -> list[Rule]:
    """Six format, range and membership checks with readable messages."""
    value = strict_amount(F.col("amount"))
    shown = F.col("amount").try_cast("double").cast("string")
    return [
        rule("txn_id must match TXNxxxxxxxx", ~F.col("txn_id").rlike(TXN_PATTERN)),
        rule("user_id must match Uxxxx", ~F.col("user_id").rlike(USER_PATTERN)),
        rule(
            F.when(value.isNull(), F.lit("amount is not numeric")).otherwise(
                F.concat(
                    F.lit("amount "), shown, F.lit(f" outside [{MIN_AMOUNT:.1f}, {MAX_AMOUNT:.1f}]")
                )
            ),
            ~in_range(value, MIN_AMOUNT, MAX_AMOUNT),
        ),
        rule(F.concat(F.lit("unknown status: "), shown_label("status")), ~F.col("status").isin(STATUSES)),
        rule(F.concat(F.lit("unknown category: "), shown_label("category")), ~F.col("category").isin(CATEGORIES)),
        rule(
            "timestamp must be YYYY-MM-DD HH:MM:SS",
            F.try_to_timestamp("timestamp", F.lit(fn.STAMP_FORMAT)).isNull(),
        ),
    ]


def amount_rules(max_amount: int) -> list[Rule]:
    value = strict_amount(F.col("amount"))
    return [
        rule("amount_type", value.isNull()),
        rule("amount_range", value.isNotNull() & ~in_range(value, MIN_AMOUNT, max_amount)),
    ]


def label_rules() -> list[Rule]:
    """Labels are checked as they come, before any tidying."""
    return [
        rule("bad_status", ~F.col("status").isin(STATUSES)),
        rule("bad_category", ~F.col("category").isin(CATEGORIES)),
    ]


def constraint_rules() -> list[Rule]:
    """The schema and constraint checks, by code."""
    return [
        rule("bad_txn_id", ~F.col("txn_id").rlike(TXN_PATTERN)),
        rule("bad_user_id", ~F.col("user_id").rlike(USER_PATTERN)),
        *amount_rules(MAX_AMOUNT),
        *label_rules(),
    ]


def process_rules() -> list[Rule]:
    """The checks of the batch pipeline."""
    return [*amount_rules(PROCESS_MAX_AMOUNT), *label_rules()]


def mark_repeats(df: DataFrame, key: str, order: str, out: str = "is_repeat") -> DataFrame:
    """Flag every row whose key was seen on an earlier row, whatever became of that row.

    Only keys that repeat are joined back, so a table without repeats costs one
    aggregation, and a key that owns many rows is handled by the hot-key join.
    """
    seen = (
        df.groupBy(key)
        .agg(F.min(order).alias("first_seen"), F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )
    return (
        join_group_stats(df, seen, [key], "n_rows", how="left")
        .withColumn(out, F.coalesce(F.col(order) > F.col("first_seen"), F.lit(False)))
        .drop("first_seen")
    )


def tidy(raw: DataFrame) -> DataFrame:
    """Trimmed, normalised columns with the reject reasons of each row, in rule order."""
    trimmed = raw.withColumns({
        "txn_id": F.trim("txn_id"),
        "user_id": F.trim("user_id"),
        "merchant": F.trim("merchant"),
        "category": F.trim("category"),
        "amount": fn.lenient_amount(F.col("amount")),
        "status": F.upper(F.trim("status")),
        "wallet_type": F.trim("wallet_type"),
        "timestamp": F.trim("timestamp"),
        "date": F.trim("date"),
    })
    marked = mark_repeats(trimmed, "txn_id", "ordinal")
    reasons = errors([
        rule("duplicate txn_id", F.col("is_repeat")),
        rule("invalid amount", F.col("amount").isNull()),
        rule("non-positive amount", F.col("amount").isNotNull() & (F.col("amount") <= 0)),
        rule(
            F.concat(F.lit("unknown status '"), shown_label("status"), F.lit("'")), ~F.col("status").isin(STATUSES)
        ),
        rule(
            F.concat(F.lit("unknown category '"), shown_label("category"), F.lit("'")),
            ~F.col("category").isin(CATEGORIES),
        ),
    ])
    return marked.withColumn("reasons", reasons).drop("is_repeat")


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values per column, counted in one pass and turned into rows."""
    counted = df.agg(*[F.count_if(fn.blank(F.col(c))).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counted.selectExpr(f"stack({len(columns)}, {pairs}) AS (field, n_missing)")


def gate_condition() -> Column:
    return F.coalesce(
        (strict_amount(F.col("amount")) > 0) & F.col("txn_id").startswith("TXN"), F.lit(False)
    )


def quality_gate(df: DataFrame, min_percent: int = GATE_PERCENT) -> DataFrame:
    """One row: how many rows pass the ingest condition, and whether that is enough."""
    good = F.count_if(gate_condition())
    return df.agg(
        F.count("*").alias("total"),
        good.alias("valid"),
        fn.percent(good, F.count("*")).alias("valid_pct"),
        (good * 100 >= F.count("*") * min_percent).alias("passed"),
    )


def require_quality(df: DataFrame, min_percent: int = GATE_PERCENT) -> None:
    """Stop before the write when too few rows are valid."""
    result = quality_gate(df, min_percent).first()
    if not result.passed:
        raise ValueError(f"validation failed: only {result.valid_pct}% of the rows are valid")
