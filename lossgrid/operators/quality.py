"""Data quality: key flags, quarantine, rule reports and guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

DUPLICATE_FLAG = "duplicated_row_dq_flag"
VALID_COL = "valid_row"


def flag_names(keys: list[str]) -> dict[str, str]:
    """Rule name -> flag column: one NULL rule per key and one duplicate rule."""
    names = {f"{key}_null_records": f"{key}_null_dq_flag" for key in keys}
    names["duplicated_records"] = DUPLICATE_FLAG
    return names


def mark_first(df: DataFrame, keys: list[str], order: list[str], name: str, salts: int | None = None) -> DataFrame:
    """Add ``name``: true for exactly one row per key, the first by the SQL terms ``order``.

    The rows of one key can be a large share of the table, so they are numbered in two rounds: first
    inside (key, salt), then only the local winners of a key meet. Losers keep their salt in the second
    round, which keeps hot keys spread there too.
    """
    salts = salts or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key_list, terms = ", ".join(f"`{k}`" for k in keys), ", ".join(order) or "1"
    numbered = (
        df.withColumn("_salt", F.spark_partition_id() % salts)
        .selectExpr("*", f"row_number() OVER (PARTITION BY {key_list}, _salt ORDER BY {terms}) AS _local")
        .withColumn("_round", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_salt")))
        .selectExpr("*", f"row_number() OVER (PARTITION BY {key_list}, _round ORDER BY {terms}) AS _final")
    )
    return numbered.select(*df.columns, ((F.col("_local") == 1) & (F.col("_final") == 1)).alias(name))


def add_dq_flags(df: DataFrame, keys: list[str], salts: int | None = None) -> DataFrame:
    """Flag NULL keys and every copy of a key but the first one, ordered by all other columns."""
    order = [f"`{c}` ASC NULLS FIRST" for c in df.columns if c not in keys]
    numbered = mark_first(df, keys, order, "_first", salts)
    null_flags = {f"{key}_null_dq_flag": F.col(key).isNull() for key in keys}
    repeated = ~F.col("_first")
    any_flag = reduce(lambda a, b: a | b, null_flags.values(), repeated)
    return numbered.select(
        *df.columns, *[c.alias(n) for n, c in null_flags.items()], repeated.alias(DUPLICATE_FLAG), (~any_flag).alias(VALID_COL)
    )


def first_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows ``add_dq_flags`` calls valid, for readers that need no flags.

    Spark keeps the first row per key of every task before it shuffles (window group limit), so one round is
    enough and a hot key sends one row per task.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    if not rest:
        return df.dropna(subset=keys).distinct()
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))
    return df.dropna(subset=keys).withColumn("_rank", first).where("_rank = 1").drop("_rank")


def valid_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where(VALID_COL).drop(*flag_names(keys).values(), VALID_COL)


def quarantine(df: DataFrame) -> DataFrame:
    return df.where(~F.col(VALID_COL))


def dq_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how often each flag is set."""
    flags = flag_names(keys).values()
    return quarantine(df).agg(*[F.count_if(F.col(flag)).alias(flag) for flag in flags])


def key_rules(keys: list[str]) -> dict[str, Column]:
    return {rule: ~F.col(flag) for rule, flag in flag_names(keys).items()}


def rule_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule with passed and failed counts, from a single aggregate."""
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()],
    )
    cells = [F.struct(F.lit(name).alias("rule"), F.col(name).alias("passed")) for name in rules]
    return (
        counted.select("_rows", F.explode(F.array(*cells)).alias("cell"))
        .select("cell.rule", "cell.passed", (F.col("_rows") - F.col("cell.passed")).alias("failed"))
    )


def missing_regressors(df: DataFrame, regressors: list[str], time_col: str) -> DataFrame:
    """NULL flags of the regressors per month and whether the month is invalid."""
    flags = df.select(time_col, *[F.col(c).isNull().alias(c) for c in regressors])
    return flags.withColumn("invalid", reduce(lambda a, b: a | b, [F.col(c) for c in regressors], F.lit(False)))


def fail_if_any(df: DataFrame, condition: Column, message: str) -> None:
    """Raise when a row meets the condition."""
    if df.where(condition).limit(1).count():
        raise ValueError(message)


def uncovered_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the left frame, with their row counts, that have no partner on the right."""
    return left.groupBy(*keys).agg(F.count("*").alias("rows")).join(right.select(*keys).distinct(), keys, "left_anti")


def join_with_coverage(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that refuses to lose rows of the left frame."""
    fail_if_any(uncovered_keys(left, right, keys), F.lit(True), f"rows without a partner on {keys}")
    return left.join(right, keys)
