"""Fixed values of the claims data model. They have to equal the values the source systems use."""

# Dimensions of the claims model and the side each one comes from.
CONTRACT_DIMS = ["PolicySubType", "AgeBucket", "UKMemberRegion"]
INVOICE_DIMS = ["SystemID", "MajorICDGroupingDescription"]
ALL_DIMS = CONTRACT_DIMS + INVOICE_DIMS

# Occurrence column, earliest usable date, runoff length.
OCCURRENCE_COL = "treatment_date"
EARLIEST_DATE = "2003-01-01"
MAX_RUNOFF_YEARS = 3

# Lag given to events that have not happened yet.
MISSING_MONTH_LAG = 99
MISSING_DAY_LAG = 99 * 365

# Fixed value: marker of a dimension that was aggregated away.
ANY = "_"

# Business filters of the conforming layer.
EXCLUDED_POLICY_TYPES = ["SAGA", "SAGA Accidental Healthcare", "Dental", "Cashback"]
EXCLUDED_PRODUCT_FAMILIES = ["JERSEY", "GUERNSEY", "IHP"]
EXCLUDED_PRODUCT_FAMILY_PARTS = ["IHP", "SAGA"]
KEPT_POLICY_SUB_TYPES = ["Employee (LC)", "Employee (SME)", "Individual", "Trust"]
KEPT_SYSTEMS = ["ACS", "CIMA"]
KEPT_INVOICE_STATUSES = ["Paid", "Pending", "Cancelled"]
REJECTED_PREAUTH_DECISIONS = ["Rejected", "Ignore"]
FIRST_PREAUTH_YEAR = 2008
KEPT_CLAIM_STATUSES = ["P", "A", "S"]

# Targets of the reserving models.
TARGETS = ["ultimate_amount_paid", "ultimate_nb_claim_paid", "ultimate_nb_invoice_paid"]
COUNT_TARGETS = ["ultimate_nb_claim_paid", "ultimate_nb_invoice_paid"]
