"""Loss triangles kept up to date: a month of invoices is merged into stored state instead of reading all invoices again.

The state is two append-only tables. The log holds one compact row per version of an invoice; the cells hold increments per
(occurrence, dimensions, lag): amounts, rows, and claims and invoices at the lag they are first seen. A batch touches the
invoices it names and the claims these belong to, before or after. Only their rows are taken from the log, by joins on their
ids; the cells they made before are taken back and the cells they make now are added. A corrected or withdrawn invoice, one that
moves to another claim, month or segment, or one that arrives late is the same case. The triangle is the sum of the increments.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lossgrid import constants as K
from lossgrid.functions.columns import same_key
from lossgrid.operators.quality import fail_if_any
from lossgrid.operators.triangle import MEASURES, cumulated
from lossgrid.session import materialise

GRAIN = [K.OCCURRENCE_COL, *K.ALL_DIMS]
_KEYS = f"{K.OCCURRENCE_COL} date, {', '.join(f'{d} string' for d in K.ALL_DIMS)}, lag int"
LOG = f"invoice_id string, claim_id string, {_KEYS}, amount double, live boolean, batch int"
CELLS = f"{_KEYS}, amount double, nb_claim bigint, nb_invoice bigint, rows bigint"
SUMS = [*MEASURES, "rows"]


class TriangleState:
    """State of one triangle in the folder ``path``; ``lag_col`` is the lag of the batches, cut at ``max_years``."""

    def __init__(self, spark: SparkSession, path: str, lag_col: str = "lag", max_years: int = K.MAX_RUNOFF_YEARS) -> None:
        self.spark, self.path, self.lag_col, self.max_lag = spark, path.rstrip("/"), lag_col, max_years * 12

    def _at(self, name: str):
        """The file system of a path of the state, and the path."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(context._jsc.hadoopConfiguration()), path

    def _numbers(self, mark: str) -> list[int]:
        files, path = self._at(mark)
        return sorted(int(s.getPath().getName()) for s in files.listStatus(path)) if files.exists(path) else []

    def _mark(self, mark: str, number: int) -> bool:
        files, path = self._at(f"{mark}/{number}")
        return files.createNewFile(path)

    def release(self, number: int) -> None:
        """Give up a batch that began and did not end, so that it can be merged again."""
        if number not in self._numbers("done"):
            files, path = self._at(f"begun/{number}")
            files.delete(path, False)

    def _read(self, name: str, schema: str) -> DataFrame:
        """Rows of finished batches: what a batch wrote counts only once its mark is set, after both tables."""
        done = self._numbers("done")
        if not done:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/{n}" for n in done])

    def merge(self, invoices: DataFrame, withdrawn: DataFrame | None = None) -> int:
        """Add a batch and return its number. An invoice replaces the version held of it; ``withdrawn`` (invoice_id) removes some.

        Raises for a null invoice_id or two rows of one invoice, which the quality checks settle before, and while another
        batch is under way: one that failed is given up with ``release``. A failure leaves the state as it was.
        """
        fail_if_any(invoices, F.col("invoice_id").isNull(), "invoices without an id")
        fail_if_any(invoices.groupBy("invoice_id").count(), F.col("count") > 1, "an invoice comes twice in one batch")
        done = self._numbers("done")
        number = (done[-1] if done else 0) + 1
        if not self._mark("begun", number):
            raise RuntimeError(f"batch {number} was begun elsewhere or failed: release it first")
        fresh = materialise(self._compact(invoices, withdrawn, number))
        before, after = self._touched(fresh)
        change = _cells(after, 1).unionByName(_cells(before, -1))
        change = change.groupBy(*GRAIN, "lag").agg(*[F.sum(m).alias(m) for m in SUMS])
        change.write.mode("overwrite").parquet(f"{self.path}/cells/{number}")
        fresh.write.mode("overwrite").parquet(f"{self.path}/log/{number}")
        self._mark("done", number)
        return number

    def _compact(self, invoices: DataFrame, withdrawn: DataFrame | None, number: int) -> DataFrame:
        lag = F.when(F.col(self.lag_col).between(0, self.max_lag), F.col(self.lag_col).cast("int"))
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in GRAIN])
        rows = invoices.select(
            F.col("invoice_id").cast("string"), F.col("claim_id").cast("string"), F.col(K.OCCURRENCE_COL).cast("date"), *[F.col(d).cast("string") for d in K.ALL_DIMS],
            lag.alias("lag"), F.col("amount_paid").cast("double").alias("amount"), (lag.isNotNull() & whole).alias("live"), F.lit(number).alias("batch"),
        )
        if withdrawn is None:
            return rows
        gone = withdrawn.select(F.col("invoice_id").cast("string")).where("invoice_id is not null").distinct().join(rows.select("invoice_id"), "invoice_id", "left_anti")
        return rows.unionByName(gone.withColumns({"live": F.lit(False), "batch": F.lit(number)}), allowMissingColumns=True)

    def _touched(self, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Live rows that decide the cells of all invoices and claims the batch touches, before it and after it."""
        log = self._read("log", LOG)
        named = fresh.select("invoice_id")
        old = materialise(_latest(log.join(named, "invoice_id", "left_semi")).where("live"))
        claims = materialise(old.unionByName(fresh.where("live")).where("claim_id is not null").select(*GRAIN, "claim_id").distinct())
        # whoever ever stood in one of these claims, with all its versions, as a later one may have left it
        ever = _in_claims(log, claims).select("invoice_id").distinct()
        related = _latest(log.join(ever, "invoice_id", "left_semi")).where("live")
        others = materialise(_in_claims(related, claims).join(named, "invoice_id", "left_anti"))
        return others.unionByName(old), others.unionByName(fresh.where("live"))

    def triangle(self, segments: list[str]) -> DataFrame:
        """Cumulative and ultimate amount, claims and invoices, as ``loss_triangle`` of all live invoices gives them."""
        sums = self._read("cells", CELLS).groupBy(K.OCCURRENCE_COL, *segments, "lag").agg(*[F.sum(m).alias(m) for m in SUMS])
        increments = sums.where("rows > 0").drop("rows").withColumn("view", F.lit("all"))
        return cumulated(materialise(increments), segments, self.max_lag).drop("view").withColumnRenamed("lag", self.lag_col)


def _latest(log: DataFrame) -> DataFrame:
    """The last version of each invoice."""
    columns = [c for c in log.columns if c != "invoice_id"]
    return log.groupBy("invoice_id").agg(F.max_by(F.struct(*columns), "batch").alias("_v")).select("invoice_id", "_v.*")


def _in_claims(rows: DataFrame, claims: DataFrame) -> DataFrame:
    named = claims.select(*[F.col(c).alias(f"_c_{c}") for c in [*GRAIN, "claim_id"]])
    match: Column = reduce(lambda a, b: a & b, [same_key(F.col(c), F.col(f"_c_{c}")) for c in [*GRAIN, "claim_id"]])
    return rows.join(named, match, "left_semi")


def _cells(rows: DataFrame, sign: int) -> DataFrame:
    """Increments of live rows: amounts, rows and invoices at their lags, claims at the lag they are first seen."""
    zero = F.lit(0).cast("bigint")
    own = rows.select(
        *GRAIN, "lag", (F.coalesce("amount", F.lit(0.0)) * sign).alias("amount"), zero.alias("nb_claim"), F.lit(sign).cast("bigint").alias("nb_invoice"), F.lit(sign).cast("bigint").alias("rows")
    )
    seen = rows.where("claim_id is not null").groupBy(*GRAIN, "claim_id").agg(F.min("lag").alias("lag"))
    first = seen.select(*GRAIN, "lag", F.lit(0.0).alias("amount"), F.lit(sign).cast("bigint").alias("nb_claim"), zero.alias("nb_invoice"), zero.alias("rows"))
    return own.unionByName(first)
