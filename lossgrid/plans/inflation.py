"""The inflation run: census, invoice aggregate, development correction, portfolio, cluster series."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame

from lossgrid.operators import portfolio, predictions
from lossgrid.plans.claims import ClaimsRun
from lossgrid.session import materialise
from lossgrid.sources import catalog


def reserving_export(payload: DataFrame, run_type: str) -> DataFrame:
    """Reserving payload -> latest -> not stale -> coalesced -> priced export; steps that are read several times are written."""
    keys = ["PolicySubType", "MajorICDGroupingDescription", "lag"]
    latest = materialise(predictions.latest_predictions(payload, keys))
    coalesced = materialise(predictions.coalesce_targets(predictions.drop_stale(latest), run_type))
    return predictions.export_predictions(coalesced)


@dataclass
class InflationRun:
    """Builds each table of the run from ``source(name)`` and the tables of the claims run.

    ``shares`` are claims runs over parts of the invoices, each invoice with all its copies in one of them: where there are
    several, the invoices of one after the other are written, and no more than one share of them is shuffled at a time.
    """

    source: Callable[[str], DataFrame]
    claims: ClaimsRun
    as_of: str
    cut_off: str
    training_begin: str
    training_end: str
    shares: list[ClaimsRun] = field(default_factory=list)

    def contract_versions(self) -> DataFrame:
        versions = predictions.rename_first(self.source("contract_versions"), portfolio.MEMBER_NAMES)
        return self.claims.contracts(write=True).join(versions, portfolio.VERSION_KEYS)

    def member_months(self, write: bool = False) -> DataFrame:
        """With ``write``, the active members are written first: their shuffles are gone before those of the versions."""
        active = self.claims.checked("active_members")
        return portfolio.monthly_members(self.contract_versions(), materialise(active) if write else active, self.as_of, self.cut_off)

    def census_cube(self, write: bool = False) -> DataFrame:
        return portfolio.census_cube(self.member_months(write))

    def invoices(self) -> DataFrame:
        if len(self.shares) < 2:
            return self.claims.invoices()
        contracts = self.claims.contracts(write=True)
        for run in self.shares:
            run.once("contracts", lambda: contracts)
        return reduce(DataFrame.unionAll, [materialise(portfolio.counted_invoices(run.invoices(), self.cut_off)) for run in self.shares])

    def invoice_months(self) -> DataFrame:
        return portfolio.monthly_invoices(self.invoices(), self.cut_off)

    def coefficients(self) -> DataFrame:
        export = materialise(reserving_export(self.source("reserving_payload"), "ibnr_inflation"))
        return portfolio.development_coefficients(export)

    def facts(self, compensate: bool = False) -> DataFrame:
        """The monthly invoice aggregate, written: it gives both the dimension pairs and the amounts."""
        invoices = self.invoice_months()
        if compensate:
            segments = ["PolicySubType", "MajorICDGroupingDescription"]
            invoices = portfolio.apply_coefficients(invoices, self.coefficients(), segments)
        return materialise(invoices)

    def dense(self, compensate: bool = False) -> DataFrame:
        return portfolio.dense_portfolio(self.census_cube(), self.facts(compensate))

    def series(self, compensate: bool = False) -> DataFrame:
        """Claims and members both read the census, the facts and the clusters, so these are written first."""
        return portfolio.cluster_series(materialise(self.census_cube()), self.facts(compensate), materialise(self.source("clusters")))

    def vintage(self) -> DataFrame:
        return catalog.vintage_scan(self.source("external_regressors"), self.training_end)

    def gold(self, compensate: bool = False) -> DataFrame:
        return portfolio.add_regressors(self.series(compensate), self.vintage(), self.training_begin)
