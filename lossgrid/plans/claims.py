"""The claims feature run: clean sources, contracts, invoices, triangles, gold table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lossgrid import constants as K
from lossgrid.operators import conform, quality, triangle
from lossgrid.session import materialise

# Primary keys of the source and derived tables.
PRIMARY_KEYS = {
    "policies": ["PolicyID", "SystemID", "HistoryID"],
    "members": ["MemberID", "PolicyID", "HistoryID"],
    "geography": ["PostCode"],
    "invoicebase": ["InvoiceKey"],
    "invoicelink": ["InvoiceKey"],
    "contracts": ["PolicyID", "SystemID", "member_id", "HistoryID"],
    "invoices": ["invoice_id"],
    "preauthbase": ["PreAuthTreatmentKey", "PreAuthTreatmentHistoryKey"],
    "claimlink": ["ClaimKey"],
    "claimcontract": ["claim_id"],
    "active_members": ["PolicyID", "MemberID", "YearMonthDate"],
    "external_regressors": ["SeenMonth", "YearMonthDate"],
    "portfolio": ["year_month_date", *K.ALL_DIMS],
}

# columns of the invoice table that later steps read
INVOICE_COLUMNS = [
    "invoice_id", "claim_id", "treatment_date", "reception_date", "payment_date", "amount_paid", "InvoiceStatus", "Age", *K.ALL_DIMS,
]


@dataclass
class ClaimsRun:
    """Builds each table of the run from ``source(name)``, once per run.

    Tables that feed several branches are written to the shared folder by the methods that branch.
    """

    source: Callable[[str], DataFrame]
    as_of: str
    earliest: str = K.EARLIEST_DATE
    first_preauth_year: int = K.FIRST_PREAUTH_YEAR
    built: dict[str, DataFrame] = field(default_factory=dict)

    def once(self, name: str, build: Callable[[], DataFrame], write: bool = False) -> DataFrame:
        """The table ``name``, built on first use; ``write`` stores it if that has not happened yet."""
        if name not in self.built:
            self.built[name] = build()
        if write and f"{name} written" not in self.built:
            self.built[name] = self.built[f"{name} written"] = materialise(self.built[name])
        return self.built[name]

    def checked(self, name: str) -> DataFrame:
        """Valid rows of a source table.

        Contracts, invoices and claim contracts need no check of their own: they join checked tables on the full
        keys of all but one side, so the key of that side stays unique and not NULL.
        """
        return quality.first_copies(self.source(name), PRIMARY_KEYS[name])

    def policies(self) -> DataFrame:
        return conform.filter_policies(self.checked("policies"), self.earliest)

    def members(self) -> DataFrame:
        return conform.clean_members(self.checked("members"))

    def geography(self) -> DataFrame:
        return conform.clean_geography(self.checked("geography"))

    def contracts(self, write: bool = False) -> DataFrame:
        def build() -> DataFrame:
            return conform.build_contracts(self.policies(), self.members(), self.geography())

        return self.once("contracts", build, write)

    def invoicebase(self) -> DataFrame:
        return conform.filter_invoicebase(self.checked("invoicebase"), self.as_of, self.earliest)

    def invoicelink(self) -> DataFrame:
        return conform.clean_invoicelink(self.checked("invoicelink"))

    def invoices(self) -> DataFrame:
        def build() -> DataFrame:
            joined = conform.build_invoices(self.invoicebase(), self.invoicelink(), self.contracts())
            return joined.select(*INVOICE_COLUMNS)

        return self.once("invoices", build)

    def lagged_invoices(self, write: bool = False) -> DataFrame:
        return self.once("lagged_invoices", lambda: conform.add_lag_features(self.invoices()), write)

    def preauth(self, before: str) -> DataFrame:
        base = conform.filter_preauthbase(self.checked("preauthbase"), before, self.first_preauth_year)
        links = conform.clean_claimlink(self.checked("claimlink"))
        claims = conform.build_claimcontract(links, self.contracts())
        return conform.build_preauth(base, claims)

    def features(self, segments: list[str], preauth_before: str, max_lags: int = 12) -> DataFrame:
        """Contracts feed invoices and pre-authorisations, invoices feed triangles and processing times: both are written."""
        self.contracts(write=True)
        invoices = self.lagged_invoices(write=True)
        return triangle.feature_table(invoices, self.preauth(preauth_before), segments, max_lags)

    def gold(self, segments: list[str], start: str, end: str, preauth_before: str, years: int, max_lags: int = 12) -> DataFrame:
        return triangle.gold_slice(self.features(segments, preauth_before, max_lags), segments, start, end, years)
