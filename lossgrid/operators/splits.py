"""Train / validation / test splits and folds as a ``split_name`` or ``fold`` column.

A split is a set of cut values: exact order statistics give the cuts, and every row is labelled by comparing
with them. No row is ordered or moved for the label itself.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid.functions.columns import same_key
from lossgrid.operators.order_stats import running_totals, values_at_ranks
from lossgrid.session import materialise

TRAIN, VALIDATION, TEST = "train", "val", "test"


def check_arguments(
    *,
    test_size: float | None = None,
    train_size: float | None = None,
    val_size: float | None = None,
    validation: bool = False,
    seed: int | None = None,
    date_col: str | None = None,
    stratify: bool = False,
    kind: str = "random",
    cutoff: object = None,
) -> None:
    """Refuse contradictory split arguments."""
    problems = {
        "give either the train or the test size": test_size is not None and train_size is not None,
        "a validation size needs the validation split": val_size is not None and not validation,
        "a time split cannot be stratified": kind == "time" and stratify,
        "a time split needs a date column": kind == "time" and date_col is None,
        "a random split needs a seed": kind == "random" and seed is None,
        "give either a cut-off or sizes": cutoff is not None and (test_size is not None or train_size is not None),
    }
    found = [text for text, wrong in problems.items() if wrong]
    if found:
        raise ValueError("; ".join(found))


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def hash_order(keys: list[str], seed: int) -> Column:
    """Reproducible random order of unique keys."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _part_sizes(rows: Column, test_size: float, val_size: float | None) -> tuple[Column, Column]:
    """Rows of the test and of the validation set, rounded up; validation is a share of what is left."""
    tests = F.ceil(rows * F.lit(test_size))
    return tests, F.ceil((rows - tests) * F.lit(val_size or 0.0))


#: Leading hexadecimal digits of a hash that are counted; hashes are even, so each prefix holds its share of the rows.
PREFIX_DIGITS = 4


def _hash_ranks(hashed: DataFrame, by: list[str], ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """Rows (by, _hash, n_before, n_all) of the hash prefixes that hold a rank of interest.

    Rows are only counted per prefix; those of the prefixes that hold a cut, a vanishing share, are the ones ordered.
    """
    prefix = F.substring("_hash", 1, PREFIX_DIGITS).alias("_prefix")
    counts = materialise(hashed.groupBy(*by, prefix).agg(F.count("*").alias("n")))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select(*[F.col(c).alias(f"_p_{c}") for c in by], F.col("_prefix").alias("_p_prefix"), "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"), F.sum("n").over(group).alias("n_all"))
    held = reduce(lambda a, b: a | b, [(F.col("_start") <= r) & (r < F.col("_start") + F.col("n")) for r in ranks(F.col("n_all"))])
    same = reduce(lambda a, b: a & b, [same_key(F.col(c), F.col(f"_p_{c}")) for c in by], F.col("_prefix") == F.col("_p_prefix"))
    inside = Window.partitionBy(*by, "_prefix").orderBy("_hash")
    near = hashed.withColumn("_prefix", prefix).join(placed.where(held).drop("n"), same)
    return near.select(*by, "_hash", (F.col("_start") + F.row_number().over(inside) - 1).alias("n_before"), "n_all")


def random_split(
    df: DataFrame,
    keys: list[str],
    seed: int,
    test_size: float = 0.1,
    val_size: float | None = None,
    stratify: str | None = None,
) -> DataFrame:
    """Exact-size random split by the hash order of unique keys, inside each class when stratified."""
    by = [stratify] if stratify else []
    hashed = df.withColumn("_hash", hash_order(keys, seed))

    def last_ranks(rows: Column) -> list[Column]:
        tests, vals = _part_sizes(rows, test_size, val_size)
        return [tests - 1, tests + vals - 1]

    ranked = _hash_ranks(hashed.select(*by, "_hash"), by, last_ranks)
    tests, vals = _part_sizes(F.col("n_all"), test_size, val_size)
    cuts = ranked.groupBy(*by).agg(
        F.max(F.when(F.col("n_before") < tests, F.col("_hash"))).alias("_test_cut"),
        F.max(F.when(F.col("n_before") < tests + vals, F.col("_hash"))).alias("_val_cut"),
    )
    if by:
        cuts = cuts.withColumnRenamed(stratify, "_class")
        marked = hashed.join(cuts, same_key(F.col(stratify), F.col("_class")), "left").drop("_class")
    else:
        row = cuts.first()
        marked = hashed.withColumns({"_test_cut": F.lit(row["_test_cut"]), "_val_cut": F.lit(row["_val_cut"])})
    name = (
        F.when(F.col("_hash") <= F.col("_test_cut"), TEST)
        .when((F.col("_hash") <= F.col("_val_cut")) & F.lit(bool(val_size)), VALIDATION)
        .otherwise(TRAIN)
    )
    return marked.withColumn("split_name", name).drop("_hash", "_test_cut", "_val_cut")


def time_cuts(df: DataFrame, date_col: str, train_size: float, val_size: float | None = None) -> dict[str, object]:
    """First date of the test set and, with ``val_size``, of the validation set, counted over distinct dates."""
    dates = df.select(date_col).where(F.col(date_col).isNotNull()).distinct()
    total = dates.count()
    trained = int(total * train_size)
    kept = int(trained * (1 - val_size)) if val_size else trained
    ranks = sorted({r for r in (trained, kept) if r < total})
    found = {r["rank"]: r[date_col] for r in values_at_ranks(dates, date_col, ranks).collect()} if ranks else {}
    return {"test": found.get(trained), "val": found.get(kept) if val_size else None}


def time_split(df: DataFrame, date_col: str, train_size: float, val_size: float | None = None) -> DataFrame:
    """Split whole dates: the first share trains, the last share of the training dates validates."""
    cuts = time_cuts(df, date_col, train_size, val_size)
    return cutoff_split(df, date_col, cuts["test"], cuts["val"])


def cutoff_split(df: DataFrame, date_col: str, train_cutoff, val_cutoff=None) -> DataFrame:
    """Dates before the cut-off train, the others test; ``val_cutoff`` splits the training dates alike."""
    kind = df.schema[date_col].dataType
    name = F.lit(TRAIN)
    if val_cutoff is not None:
        name = F.when(F.col(date_col) >= F.lit(val_cutoff).cast(kind), VALIDATION).otherwise(name)
    if train_cutoff is not None:
        name = F.when(F.col(date_col) >= F.lit(train_cutoff).cast(kind), TEST).otherwise(name)
    return df.withColumn("split_name", name)


def _fold_of(order: Column, cuts: list) -> Column:
    """Number of cut values that are not greater than the row."""
    return sum((F.when(order >= F.lit(cut), 1).otherwise(0) for cut in cuts), F.lit(0)).cast("int")


def _cut_values(df: DataFrame, order_col: str, starts: list[int]) -> list:
    """Values at the given ranks of a unique order column; ranks past the end are left out."""
    found = {r["rank"]: r[order_col] for r in values_at_ranks(df.select(order_col), order_col, starts).collect()}
    return [found[s] for s in starts if s in found]


def k_folds(df: DataFrame, order_col: str, k: int = 3) -> DataFrame:
    """Contiguous folds of a unique order column; the first ``rows % k`` folds have one row more."""
    rows = df.count()
    sizes = [rows // k + (1 if i < rows % k else 0) for i in range(k)]
    starts = [sum(sizes[:i]) for i in range(1, k)]
    return df.withColumn("fold", _fold_of(F.col(order_col), _cut_values(df, order_col, starts)))


def stratified_k_folds(df: DataFrame, label: str, order_col: str, k: int = 3) -> DataFrame:
    """Contiguous folds inside each class, with the classes taking turns for the larger folds.

    Classes are ordered by their first row. A class that covers places ``s..s+n`` of the sorted labels puts
    as many rows into fold i as there are places p with ``p % k == i``.
    """
    classes = df.groupBy(label).agg(F.min(order_col).alias("_first"), F.count("*").alias("_n"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    placed = classes.select(F.col(label).alias("_class"), "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))

    def in_fold(i: int) -> Column:
        def up_to(p: Column) -> Column:
            return F.floor((p - F.lit(i) + F.lit(k - 1)) / F.lit(k))

        return up_to(F.col("_start") + F.col("_n")) - up_to(F.col("_start"))

    ends = placed.withColumn("_ends", F.array(*[sum((in_fold(j) for j in range(i + 1)), F.lit(0)) for i in range(k)]))
    # each fold starts within one row of its share of the class, so only buckets with such a rank are ordered
    ranked = running_totals(
        df.select(label, order_col), order_col, {"n": F.count("*")}, [label],
        ranks=lambda n: [F.greatest(F.floor(n * (i + 1) / k) + d, F.lit(0)) for i in range(k - 1) for d in range(-k, k + 1)],
    )
    cuts = (
        ranked.join(ends, same_key(F.col(label), F.col("_class")))
        .groupBy("_class")
        .agg(*[F.min(F.when(F.col("n_before") >= F.element_at("_ends", i + 1), F.col(order_col))).alias(f"_cut{i}") for i in range(k - 1)])
    )
    fold = sum((F.when(F.col(order_col) >= F.col(f"_cut{i}"), 1).otherwise(0) for i in range(k - 1)), F.lit(0))
    marked = df.join(cuts, same_key(F.col(label), F.col("_class")), "left")
    return marked.withColumn("fold", fold.cast("int")).drop("_class", *[f"_cut{i}" for i in range(k - 1)])


def expanding_folds(df: DataFrame, order_col: str, k: int = 3) -> DataFrame:
    """Rows repeated per fold with their role: a block tests once and trains all later folds."""
    rows = df.count()
    size = rows // (k + 1)
    starts = [rows - (k - i) * size for i in range(k)]
    block = _fold_of(F.col(order_col), _cut_values(df, order_col, starts))
    roles = F.array(
        *[
            F.struct(F.lit(i).alias("fold"), F.when(block == i + 1, TEST).when(block <= i, TRAIN).alias("role"))
            for i in range(k)
        ]
    )
    return df.select("*", F.explode(roles).alias("_r")).select(*df.columns, "_r.fold", "_r.role").where("role IS NOT NULL")
