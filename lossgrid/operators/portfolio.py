"""Inflation portfolio: member census, invoice aggregate, development coefficients, cluster series."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from lossgrid import constants as K
from lossgrid.functions.columns import age_bucket, age_years, ratio, same_key, short_id
from lossgrid.operators.predictions import rename_first
from lossgrid.operators.quality import fail_if_any, first_copies, join_with_coverage, mark_first, missing_regressors
from lossgrid.session import materialise

MONTH = "year_month_date"
METRICS = ["amount_paid", "nb_claim", "nb_invoice"]
VERSION_KEYS = ["PolicyID", "member_id"]


def subsets(names: list[str]) -> list[list[str]]:
    """All subsets, from the full list down to the empty one."""
    return [list(kept) for size in range(len(names), -1, -1) for kept in combinations(names, size)]


def active_version(contracts: DataFrame, as_of: str, tiebreak: list[str] | None = None) -> DataFrame:
    """Give the latest version of each (policy, member) an open end at ``as_of``.

    Exactly one version is the latest: versions that start on one day are told apart by ``tiebreak`` and then by all
    other columns, equal rows by chance. A member with very many versions is spread over salted windows.
    """
    first = ["VersionStartDate", *(tiebreak or [])]
    rest = [f.name for f in contracts.schema.fields if f.name not in [*first, *VERSION_KEYS] and f.dataType.typeName() != "map"]
    marked = mark_first(contracts, VERSION_KEYS, [f"`{c}` DESC NULLS LAST" for c in [*first, *rest]], "_latest")
    end = F.when(F.col("_latest"), F.lit(as_of).cast("date")).otherwise(F.to_date("VersionEndDate"))
    return marked.withColumn("VersionEndDate", end).drop("_latest")


def valid_version(contracts: DataFrame, active: DataFrame, before: str) -> DataFrame:
    """Active member months before the cut-off with each contract version valid on that day.

    The versions are spread over the months they cover, so the join is on (policy, member, month) and tests
    only versions of that month, whatever the number of versions and months of one member.
    """
    end_of_use = F.lit(before).cast("date")
    months = F.sequence(
        F.trunc("VersionStartDate", "MM"),
        F.trunc(F.least(F.col("VersionEndDate"), end_of_use), "MM"),
        F.expr("interval 1 month"),
    )
    started = F.trunc("VersionStartDate", "MM") <= F.trunc(F.least(F.col("VersionEndDate"), end_of_use), "MM")
    spread = contracts.where(started).withColumn("_month", F.explode(months))
    wanted = active.where(F.col(MONTH) < end_of_use).withColumn("_month", F.trunc(MONTH, "MM"))
    on_day = (F.col("VersionStartDate") <= F.col(MONTH)) & (F.col("VersionEndDate") >= F.col(MONTH))
    return spread.join(wanted, [*VERSION_KEYS, "_month"]).where(on_day).drop("_month")


def monthly_members(contracts: DataFrame, active: DataFrame, as_of: str, before: str) -> DataFrame:
    """Member months with their contract dimensions and age bucket."""
    contracts, active = rename_first(contracts, MEMBER_NAMES), rename_first(active, MEMBER_NAMES | REGRESSOR_MONTH)
    versions = valid_version(active_version(contracts, as_of), active, before)
    aged = versions.where(F.col("DateOfBirth") <= F.col(MONTH))
    return aged.withColumn("AgeBucket", age_bucket(age_years(F.col(MONTH), F.col("DateOfBirth"))))


def monthly_census(members: DataFrame) -> DataFrame:
    """Distinct members per month and all contract dimensions."""
    return members.groupBy(MONTH, *K.CONTRACT_DIMS).agg(F.count_distinct("member_id").alias("nb_member"))


def census_cube(members: DataFrame) -> DataFrame:
    """Distinct members per month for every subset of the contract dimensions; a removed one shows as ``_``.

    A member month has few dimension combinations, so its subsets are formed locally and only partial
    counts are shuffled a second time. ``dims_kept`` tells a removed dimension from a value that is ``_``.
    """
    dims = K.CONTRACT_DIMS
    per_member = members.groupBy(MONTH, "member_id").agg(F.collect_set(F.struct(*dims)).alias("combos"))

    def project(kept: list[str]) -> Column:
        code = sum(1 << i for i, d in enumerate(dims) if d in kept)
        return F.transform(
            "combos",
            lambda c: F.struct(
                F.lit(code).alias("dims_kept"),
                *[(c[d] if d in kept else F.lit(K.ANY)).alias(d) for d in dims],
            ),
        )

    every = F.array_distinct(F.flatten(F.array(*[project(kept) for kept in subsets(dims)])))
    return (
        per_member.select(MONTH, F.explode(every).alias("cell"))
        .groupBy(MONTH, "cell.dims_kept", *[F.col(f"cell.{d}").alias(d) for d in dims])
        .agg(F.count("*").alias("nb_member"))
    )


def grouping_sets_total(
    df: DataFrame, fixed: list[str], dims: list[str], aggregates: dict[str, Column], kept_dims: list[list[str]] | None = None
) -> DataFrame:
    """Additive aggregates for every subset of ``dims``, or for those in ``kept_dims``, in one scan.

    Removed dimensions are NULL, ``dims_kept`` names the subset.
    """
    sets = [[*fixed, *kept] for kept in (subsets(dims) if kept_dims is None else kept_dims)]
    code = reduce(lambda a, b: a + b, [(1 - F.grouping(d).cast("int")) * (1 << i) for i, d in enumerate(dims)])
    grouped = df.groupingSets(sets, *fixed, *dims)
    return grouped.agg(code.alias("dims_kept"), *[expr.alias(name) for name, expr in aggregates.items()])


def counted_invoices(invoices: DataFrame, before: str) -> DataFrame:
    """The rows and columns of the invoices of the claims run that ``monthly_invoices`` reads."""
    return invoices.where(F.col("payment_date") < F.lit(before).cast("date")).select("invoice_id", "claim_id", "treatment_date", "payment_date", "amount_paid", *K.ALL_DIMS)


def monthly_invoices(invoices: DataFrame, before: str) -> DataFrame:
    """Paid amount, distinct claims and invoices per month and dimensions, from the first date column present."""
    invoices = rename_first(invoices, INVOICE_NAMES)
    source = next((c for c in ["admission_date", "treatment_date", "reception_date"] if c in invoices.columns), None)
    if source is None:
        raise ValueError("invoices need admission_date, treatment_date or reception_date")
    kept = invoices.where(F.col("claim_status").isin(K.KEPT_CLAIM_STATUSES)) if "claim_status" in invoices.columns else invoices
    return (
        kept.where(F.col("payment_date") < F.lit(before).cast("date"))
        .groupBy(F.trunc(source, "MM").alias(MONTH), *K.ALL_DIMS)
        .agg(
            F.coalesce(F.sum("amount_paid"), F.lit(0.0)).alias("amount_paid"),
            F.count_distinct("claim_id").alias("nb_claim"),
            F.count("invoice_id").alias("nb_invoice"),
        )
    )


# Development coefficient of each target and the metric it scales.
COEFFICIENTS = {
    "ultimate_amount_paid": ("coef_amount", "amount_paid"),
    "ultimate_nb_claim_paid": ("coef_nb_claim", "nb_claim"),
    "ultimate_nb_invoice_paid": ("coef_nb_invoice", "nb_invoice"),
}


def development_coefficients(predictions: DataFrame) -> DataFrame:
    """Predicted ultimate over cumulative for the first experiment; target words leave its name."""
    predictions = rename_first(predictions, EXPORT_NAMES)
    first = predictions.agg(F.min("full_experiment").alias("full_experiment"))
    chosen = predictions.where(F.col("full_experiment") == first.scalar())
    coefs = {
        coef: ratio(F.col(f"{target}_predicted"), F.col(target.replace("ultimate", "cumulative")))
        for target, (coef, _) in COEFFICIENTS.items()
    }
    return chosen.withColumns(coefs).withColumn(
        "full_experiment", F.regexp_replace("full_experiment", "nb_invoice|nb_claim|Amount|Charge", "")
    )


def one_value(column: Column, message: str) -> Column:
    """Aggregate: the single value of a group; two different ones raise."""
    return F.when(F.coalesce(F.min(column) == F.max(column), F.lit(True)), F.max(column)).otherwise(F.raise_error(F.lit(message)))


def apply_coefficients(invoices: DataFrame, coefficients: DataFrame, segments: list) -> DataFrame:
    """Scale the monthly metrics by the coefficient of their segment and month, keeping unmatched rows of both sides.

    ``segments`` may be a list of names or of lists of names. The three coefficients become one row per
    key first, so the invoices are joined once.
    """
    flat = [name for item in segments for name in ([item] if isinstance(item, str) else item)]
    shared = [c for c in dict.fromkeys(flat) if c in invoices.columns and c in coefficients.columns]
    keys = [*shared, MONTH]
    wide = (
        coefficients.withColumnRenamed("treatment_date", MONTH)
        .groupBy(*keys)
        .agg(*[one_value(F.when(F.col("target") == t, F.col(coef)), f"two values of {coef} for one key").alias(coef) for t, (coef, _) in COEFFICIENTS.items()])
    )
    joined = invoices.join(wide, keys, "full_outer")
    return joined.withColumns(
        {m: F.coalesce(F.col(m) * F.col(coef), F.col(m)).cast("double") for coef, m in COEFFICIENTS.values()}
    )


#: Rows of the smaller side of a product that every task may hold.
PRODUCT_ROWS = 20_000


def all_combinations(left: DataFrame, right: DataFrame, rows: int = PRODUCT_ROWS) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, the side with few rows.

    ``right`` is written and counted. Up to ``rows`` of it go to every task beside the left rows, which then stay where
    they are. More of it is dealt over as many parts as its number asks for, and the left rows over slices, as an
    equi-join on (part, slice).
    """
    right = materialise(right)
    count = right.count()
    if count <= rows:
        return left.withColumn("_part", F.lit(0)).join(F.broadcast(right.withColumn("_part", F.lit(0))), "_part").drop("_part")
    parts, slices = -(-count // rows), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = right.withColumn("_part", F.pmod(F.xxhash64(*right.columns), F.lit(parts)).cast("int"))
    dealt = dealt.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    visiting = left.withColumn("_slice", F.pmod(F.xxhash64(*left.columns), F.lit(slices)).cast("int"))
    visiting = visiting.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return visiting.join(dealt, ["_part", "_slice"]).drop("_part", "_slice")


def dense_portfolio(census: DataFrame, invoices: DataFrame) -> DataFrame:
    """Census rows for every pair of invoice dimensions, with the invoice metrics or zeros."""
    contract_keys = [MONTH, *K.CONTRACT_DIMS]
    grid = all_combinations(census.select(*contract_keys, "nb_member"), invoices.select(*K.INVOICE_DIMS).distinct())
    facts = invoices.select(MONTH, *K.ALL_DIMS, *METRICS)
    return grid.join(facts, [MONTH, *K.ALL_DIMS], "left").fillna(0, subset=METRICS)


def add_ratios(df: DataFrame) -> DataFrame:
    """Frequencies, severities and burning cost; NULL where the denominator is zero."""
    amount, claims, count, members = (F.col(c) for c in ["amount_paid", "nb_claim", "nb_invoice", "nb_member"])
    return df.withColumns(
        {
            "frequency_claim": ratio(claims, members),
            "severity_claim": ratio(amount, claims),
            "frequency_invoice": ratio(count, members),
            "severity_invoice": ratio(amount, count),
            "burning_cost": ratio(amount, members),
        }
    )


def cluster_dims(clusters: DataFrame) -> DataFrame:
    """Distinct dimension rows of each cluster, with every dimension column; NULL means any value."""
    missing = {d: F.lit(None).cast("string") for d in K.ALL_DIMS if d not in clusters.columns}
    return clusters.withColumns(missing).select("cluster_id", *K.ALL_DIMS).distinct()


def _same_dims(left: str, dims: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [same_key(F.col(d), F.col(f"{left}{d}")) for d in dims])


def _fixed_dims(clusters: DataFrame, dims: list[str]) -> list[list[str]]:
    """Which dimensions the clusters fix: at most 2 to the number of dimensions lists."""
    found = clusters.select(*[F.col(d).isNotNull().alias(d) for d in dims]).distinct().collect()
    return [[d for d in dims if r[d]] for r in found]


def _with_known_pairs(clusters: DataFrame, invoices: DataFrame, invoice_dims: list[str]) -> DataFrame:
    """The cluster rows whose invoice dimensions occur in the invoices of any month."""
    pairs = invoices.select(*K.INVOICE_DIMS).distinct()
    if not invoice_dims:
        return clusters.join(pairs.limit(1).select(), F.lit(True), "left_semi")
    present = grouping_sets_total(pairs, [], invoice_dims, {"n": F.count("*")}, _fixed_dims(clusters, invoice_dims))
    return clusters.join(present.select(*[F.col(d).alias(f"_{d}") for d in invoice_dims]), _same_dims("_", invoice_dims), "left_semi")


def cluster_claims(census: DataFrame, invoices: DataFrame, clusters: DataFrame, dims: list[str], silent: bool = True) -> DataFrame:
    """Claims per cluster and month, of the invoice months whose members the census has.

    With ``silent``, months with members of the cluster and without claims have zeros.

    They are totalled for the sets of dimensions that clusters fix, so a cluster finds its total by an equi-join on
    these instead of testing every fact against every cluster.
    """
    detailed = reduce(lambda a, b: a & b, [F.col(d) != K.ANY for d in K.CONTRACT_DIMS])
    cell = [MONTH, *K.CONTRACT_DIMS]
    facts = invoices.dropna(subset=K.INVOICE_DIMS).join(census.where(detailed).select(*cell), cell, "left_semi")
    sums = {m: F.sum(F.coalesce(F.col(m), F.lit(0))) for m in METRICS}
    totals = grouping_sets_total(facts, [MONTH], dims, sums, _fixed_dims(clusters, dims))
    keyed = clusters.select("cluster_id", *[F.col(d).alias(f"_{d}") for d in dims])
    claims = totals.join(keyed, _same_dims("_", dims)).groupBy("cluster_id", MONTH).agg(*[F.sum(m).alias(m) for m in METRICS])
    if not silent:
        return claims
    contract_dims = [d for d in dims if d in K.CONTRACT_DIMS]
    cells = grouping_sets_total(census.where(detailed), [MONTH], contract_dims, {"n": F.count("*")}, _fixed_dims(clusters, contract_dims))
    known = _with_known_pairs(clusters, invoices, [d for d in dims if d in K.INVOICE_DIMS])
    known = known.select("cluster_id", *[F.col(d).alias(f"_{d}") for d in contract_dims])
    months = cells.join(known, _same_dims("_", contract_dims)).select("cluster_id", MONTH).distinct()
    return months.join(claims, ["cluster_id", MONTH], "left").fillna(0, subset=METRICS)


def cluster_members(census: DataFrame, invoices: DataFrame, clusters: DataFrame, invoice_dims: list[str]) -> DataFrame:
    """Members per cluster and month, from the census row that fixes what the cluster fixes and nothing else.

    A cluster row counts only if invoices with the invoice dimensions it fixes exist in any month.
    """
    known = _with_known_pairs(clusters, invoices, invoice_dims)
    wanted = known.select("cluster_id", *[F.coalesce(F.col(d), F.lit(K.ANY)).alias(f"_{d}") for d in K.CONTRACT_DIMS]).distinct()
    matched = census.join(wanted, _same_dims("_", K.CONTRACT_DIMS))
    return matched.groupBy("cluster_id", MONTH).agg(F.sum("nb_member").alias("nb_member"))


def cluster_series(census: DataFrame, invoices: DataFrame, clusters: DataFrame) -> DataFrame:
    """Monthly claims, members and ratios of all clusters, from the census cube and the invoice months; no grid is built."""
    wanted = cluster_dims(clusters)
    used = [d for d in K.ALL_DIMS if d in clusters.columns]
    members = cluster_members(census, invoices, wanted, [d for d in K.INVOICE_DIMS if d in used])
    claims = cluster_claims(census, invoices, wanted, used, silent=False)
    return add_ratios(members.join(claims, ["cluster_id", MONTH], "left").fillna(0, subset=METRICS))


# Names that columns of the inputs may arrive under.
REGRESSOR_MONTH = {MONTH: ["YearMonthDate", "year_month_date", "TreatmentDate", "treatment_date"]}
MEMBER_NAMES = {"member_id": ["MemberID", "MemberIDPK"]}
INVOICE_NAMES = {"admission_date": ["AdmissionDate"], "treatment_date": ["TreatmentDate"], "reception_date": ["ReceptionDate"], "claim_status": ["ClaimStatus"]}
EXPORT_NAMES = {
    "segment": ["Segment"],
    "full_experiment": ["FullExperiment"],
    "target": ["Target"],
    "treatment_date": ["TreatmentDate"],
    "cumulative_amount_paid": ["CumulativeAmountPaid"],
    "cumulative_nb_claim_paid": ["CumulativeNumberClaimsPaid"],
    "cumulative_nb_invoice_paid": ["CumulativeNumberInvoicesPaid"],
    "ultimate_amount_paid_predicted": ["UltimateAmountPaidPredicted", "UltimateChargePredicted"],
    "ultimate_nb_claim_paid_predicted": ["UltimateNumberClaimsPaidPredicted", "UltimateNumberClaimsPredicted"],
    "ultimate_nb_invoice_paid_predicted": ["UltimateNumberInvoicesPaidPredicted", "UltimateNumberInvoicesPredicted"],
}


def add_regressors(series: DataFrame, regressors: DataFrame, training_begin: str) -> DataFrame:
    """Cluster series from the begin of training with the regressors of their month.

    Regressors keep the first copy of a month. A month of the series without regressors, or with an empty one, raises:
    no row is lost and none goes on with a gap.
    """
    kept = materialise(series.where(F.col(MONTH) >= F.lit(training_begin).cast("date")))  # read by two checks and the result
    valid = first_copies(rename_first(regressors, REGRESSOR_MONTH), [MONTH])
    joined = join_with_coverage(kept, valid, [MONTH])
    names = [c for c in valid.columns if c != MONTH]
    used = valid.join(kept.select(MONTH).distinct(), MONTH, "left_semi")
    fail_if_any(missing_regressors(used, names, MONTH), F.col("invalid"), "a month has an empty regressor")
    return joined


def model_grid(clusters: DataFrame) -> DataFrame:
    """One row per (target, scenario, cluster) with the configuration and the id of the model it belongs to."""
    full_name = F.concat(F.lit("inflation_scenario_"), "scenario", F.lit("_target_"), "target")
    return clusters.select(
        F.lower(F.concat(F.lit("inflation_"), F.translate(short_id(full_name), "-", "_"))).alias("model_name"),
        "target",
        "scenario",
        "cluster_id",
        "model_config",
    ).distinct()


def non_null_profile(df: DataFrame) -> DataFrame:
    """One row: non-null values per column; a column with none can be dropped."""
    return df.agg(*[F.count(c).alias(c) for c in df.columns])


def marker_probe(cube: DataFrame) -> DataFrame:
    """One row: whether each contract dimension has rows where it was aggregated away."""
    return cube.agg(*[F.bool_or(F.col(d) == K.ANY).alias(d) for d in K.CONTRACT_DIMS])


# --- stored member sketches --------------------------------------------------------------------------------

#: Registers of a sketch as a power of two; one standard error of an estimate is about 1.04 / sqrt(2 ** SKETCH_BITS).
SKETCH_BITS = 14


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (bits / 2)


def census_sketches(members: DataFrame, bits: int = SKETCH_BITS) -> DataFrame:
    """One mergeable sketch of the distinct members per month and all contract dimensions; null members do not count.

    Sketches are of bounded size, so they can be kept beside the census: a new month only appends its own rows.
    """
    return members.groupBy(MONTH, *K.CONTRACT_DIMS).agg(F.hll_sketch_agg(F.col("member_id").cast("string"), F.lit(bits)).alias("members"))


def sketch_cube(sketches: DataFrame, period: Column | None = None) -> DataFrame:
    """Estimated distinct members per month for every subset of the dimensions, merged from stored sketches alone.

    ``period`` maps a month to a longer span (a year, say), over which members are counted once. Repeated appends of a month do
    not change an estimate, as sketches of the same members merge to the same.
    """
    dims = K.CONTRACT_DIMS
    span = (F.col(MONTH) if period is None else period).alias(MONTH)
    merged = grouping_sets_total(sketches.select(span, *dims, "members"), [MONTH], dims, {"members": F.hll_union_agg("members")})
    code = F.col("dims_kept")
    shown = [F.when(code.bitwiseAND(1 << i) == 0, F.lit(K.ANY)).otherwise(F.col(d)).alias(d) for i, d in enumerate(dims)]
    return merged.select(MONTH, "dims_kept", *shown, F.hll_sketch_estimate("members").alias("nb_member"))
