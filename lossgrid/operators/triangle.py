"""Loss triangles and the reserving feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lossgrid import constants as K
from lossgrid.session import materialise
from lossgrid.functions.columns import months_since

MEASURES = ["amount", "nb_claim", "nb_invoice"]


def cumulative_cells(
    invoices: DataFrame,
    views: dict[str, tuple[Column, Column]],
    segments: list[str],
    max_years: int = K.MAX_RUNOFF_YEARS,
    occurrence: str = K.OCCURRENCE_COL,
) -> DataFrame:
    """Cumulative triangles of several views of the same invoices, in one pass over them.

    ``views`` maps a view name to (lag column, row condition). Claims and invoices are counted once per grain
    (occurrence and all five dimensions), at the lag they are first seen, and then summed to the segments.
    Each invoice is spread to one amount cell and two identity cells, so the big shuffle is keyed by the
    identity and no segment meets in one task; views are told apart only after it.
    """
    max_lag = max_years * 12
    grain = [occurrence, *K.ALL_DIMS]
    identities = {"nb_claim": "claim_id", "nb_invoice": "invoice_id"}
    lags = {v: F.when(condition & lag.between(0, max_lag), lag.cast("int")) for v, (lag, condition) in views.items()}
    nothing = F.lit(None)
    amount_cell = F.struct(
        F.lit("amount").alias("kind"), nothing.cast("string").alias("id"), F.col("amount_paid").cast("double").alias("amount"),
        F.struct(*[F.col(f"_lag_{v}").alias(v) for v in views]).alias("at"),
    )
    identity_cells = [
        F.struct(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"), nothing.cast("double").alias("amount"),
            F.struct(*[nothing.cast("int").alias(v) for v in views]).alias("at"),
        )
        for kind, key in identities.items()
    ]
    lag_columns = [f"_lag_{v}" for v in views]
    spread = (
        invoices.dropna(subset=grain)
        .select(*grain, "amount_paid", *identities.values(), *[lag.alias(f"_lag_{v}") for v, lag in lags.items()])
        .where(F.coalesce(*lag_columns).isNotNull())
        .select(*grain, *lag_columns, F.explode(F.array(amount_cell, *identity_cells)).alias("cell"))
    )
    # amounts meet per pair of lags, an identity meets itself at its smallest lags
    first_seen = spread.groupBy(*grain, F.col("cell.kind").alias("kind"), F.col("cell.id").alias("id"), F.col("cell.at").alias("at")).agg(
        F.sum("cell.amount").alias("amount"), *[F.min(c).alias(c) for c in lag_columns]
    )
    # countDistinct ignores a NULL id, so NULL ids form cells but count as zero
    counted = {k: F.count_if((F.col("kind") == k) & F.col("id").isNotNull()).alias(k) for k in identities}
    by_view = F.array(*[F.struct(F.lit(v).alias("view"), F.col(f"_lag_{v}").alias("lag")) for v in views])
    increments = (
        first_seen.select(occurrence, *segments, "kind", "id", "amount", F.inline(by_view))
        .where(F.col("lag").isNotNull())
        .groupBy("view", occurrence, *segments, "lag")
        .agg(F.sum("amount").alias("amount"), *counted.values())
    )
    return cumulated(materialise(increments), segments, max_lag, occurrence)


def cumulated(increments: DataFrame, segments: list[str], max_lag: int, occurrence: str = K.OCCURRENCE_COL) -> DataFrame:
    """Running and ultimate totals of (view, occurrence, segments, lag) increments on the grid of lags that occur in the view.

    ``increments`` is read twice: for the cells and for the lags that occur.
    """
    # at most one cell per lag of the runoff, so the map is bounded by max_lag + 1 entries
    packed = increments.groupBy("view", occurrence, *segments).agg(
        F.map_from_entries(F.collect_list(F.struct("lag", F.struct(*MEASURES)))).alias("cells")
    )
    dense = packed.select(
        "view", occurrence, *segments, F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"), "cells"
    ).withColumn("cell", F.try_element_at("cells", F.col("lag")))
    row = Window.partitionBy("view", occurrence, *segments)
    so_far = row.orderBy("lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    zero = {"amount": F.lit(0.0), "nb_claim": F.lit(0), "nb_invoice": F.lit(0)}
    value = {m: F.coalesce(F.col(f"cell.{m}"), zero[m]) for m in MEASURES}
    totals = dense.select(
        "view",
        occurrence,
        *segments,
        "lag",
        *[F.sum(value[m]).over(so_far).alias(f"cumulative_{m}") for m in MEASURES],
        *[F.sum(value[m]).over(row).alias(f"ultimate_{m}") for m in MEASURES],
    )
    # the grid holds the lags that occur anywhere in the view: at most max_lag + 1 rows per view
    return totals.join(increments.select("view", "lag").distinct(), ["view", "lag"], "left_semi")


def loss_triangle(
    invoices: DataFrame,
    lag_col: str,
    segments: list[str],
    max_years: int = K.MAX_RUNOFF_YEARS,
    occurrence: str = K.OCCURRENCE_COL,
) -> DataFrame:
    """Cumulative amount, claims and invoices per (occurrence, lag, segment) with their ultimates."""
    view = {"all": (F.col(lag_col), F.lit(True))}
    cells = cumulative_cells(invoices, view, segments, max_years, occurrence)
    return cells.drop("view").withColumnRenamed("lag", lag_col)


def paid_and_received(
    invoices: DataFrame, segments: list[str], max_years: int = K.MAX_RUNOFF_YEARS, occurrence: str = K.OCCURRENCE_COL
) -> DataFrame:
    """Paid and received triangles side by side; ultimates of the paid one stay NULL where it has no cell."""
    views = {
        "paid": (F.col("lag_treatment_payment"), F.col("payment_date").isNotNull()),
        "received": (F.col("lag_treatment_reception"), F.lit(True)),
    }
    cells = cumulative_cells(invoices, views, segments, max_years, occurrence)

    def pick(view: str, column: str) -> Column:
        return F.max(F.when(F.col("view") == view, F.col(column)))

    side_by_side = cells.groupBy(*segments, occurrence, "lag").agg(
        *[F.coalesce(pick("paid", f"cumulative_{m}"), F.lit(0)).alias(f"cumulative_{m}_paid") for m in MEASURES],
        *[pick("paid", f"ultimate_{m}").alias(f"ultimate_{m}_paid") for m in MEASURES],
        *[F.coalesce(pick("received", f"cumulative_{m}"), F.lit(0)).alias(f"cumulative_{m}_received") for m in MEASURES],
    )
    counts = ["nb_claim", "nb_invoice"]
    open_counts = {
        f"cumulative_{m}_received_but_not_paid": F.col(f"cumulative_{m}_received") - F.col(f"cumulative_{m}_paid")
        for m in counts
    }
    return side_by_side.withColumns(open_counts).drop(*[f"cumulative_{m}_received" for m in counts])


def suffix_columns(df: DataFrame, parts: list[str], suffix: str) -> DataFrame:
    """Append the suffix to every column whose name contains one of the parts."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if any(part in c for part in parts)})


def processing_times(invoices: DataFrame) -> DataFrame:
    """Mean reception-to-payment days per payment month, over the month and over each of its last four weeks.

    The first ``days in month % 7`` days belong to no week, so every month has exactly four weeks.
    """
    days = F.col("daily_lag_reception_payment")
    spare = F.day(F.last_day("payment_date")) % 7
    week = F.floor((F.day("payment_date_full") - spare - 1) / 7) + 1
    in_range = invoices.where(days.between(0, 93) & F.col("payment_date").isNotNull())
    return in_range.groupBy("payment_date").agg(
        F.avg(days).alias("avg_monthly_processing_time"),
        *[F.avg(F.when(week == w, days)).alias(f"avg_processing_time_w{w}") for w in (1, 2, 3, 4)],
    )


def preauth_counts(preauth: DataFrame, segments: list[str]) -> DataFrame:
    """Pre-authorisations per effective month and the segment columns the table has."""
    shared = [c for c in segments if c in preauth.columns]
    return preauth.groupBy("TreatmentEffectiveDate", *shared).agg(F.count("TreatmentEffectiveDate").alias("nb_preauth"))


def feature_table(
    invoices: DataFrame,
    preauth: DataFrame,
    segments: list[str],
    max_lags: int = 12,
    max_years: int = K.MAX_RUNOFF_YEARS,
    occurrence: str = K.OCCURRENCE_COL,
) -> DataFrame:
    """Triangle cells with open counts, processing times of the visible month, pre-authorisations and seasonality."""
    cells = paid_and_received(invoices, segments, max_years, occurrence).where(F.col("lag") < max_lags)
    times = processing_times(invoices)
    time_cols = [c for c in times.columns if c != "payment_date"]
    counts = preauth_counts(preauth, segments).withColumnRenamed("TreatmentEffectiveDate", occurrence)
    shared = [c for c in counts.columns if c != "nb_preauth"]
    return (
        cells.withColumn("payment_date", F.add_months(occurrence, F.col("lag")))
        .join(times, "payment_date", "left")
        .drop("payment_date")
        .fillna(0.0, subset=time_cols)
        .join(counts, shared, "left")
        .fillna(0, subset=["nb_preauth"])
        .withColumn(f"{occurrence}_month", F.month(occurrence))
    )


def gold_slice(
    features: DataFrame,
    segments: list[str],
    start: str,
    end: str,
    training_years: int,
    occurrence: str = K.OCCURRENCE_COL,
) -> DataFrame:
    """Training window with segment names; inference rows are the latest diagonal from ``start`` on."""
    first, last, seen = F.lit(start).cast("date"), F.lit(end).cast("date"), F.col(occurrence)
    on_diagonal = F.col("lag") == months_since(last, seen)
    return (
        features.where(seen.between(F.add_months(first, -12 * training_years), last))
        .withColumn("segment", F.concat_ws("_", *segments))
        .withColumn("segment_key", F.concat_ws("_", *segments, "lag"))
        .withColumn("is_inference", on_diagonal & (seen >= first))
    )


def running_distinct(
    df: DataFrame, keys: list[str], identity: str, lag_col: str, occurrence: str = K.OCCURRENCE_COL
) -> DataFrame:
    """Distinct identities seen up to each lag that occurs in the group, from the lag each is first seen."""
    group = [occurrence, *keys]
    first_seen = df.groupBy(*group, identity).agg(F.min(lag_col).alias("first"), F.collect_set(lag_col).alias("lags"))
    # one row per (group, lag) that occurs, with the identities first seen there
    cells = (
        first_seen.select(*group, identity, "first", F.explode("lags").alias("lag"))
        .groupBy(*group, "lag")
        .agg(F.count_if((F.col("lag") == F.col("first")) & F.col(identity).isNotNull()).alias("new"))
    )
    so_far = Window.partitionBy(*group).orderBy("lag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.select(*group, "lag", F.sum("new").over(so_far).alias("seen"))
