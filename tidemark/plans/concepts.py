"""Default concept map: which reported concepts fill which normalized field."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import values_table

# Version, taxonomy order, and concepts of each field in order of preference.
CONCEPT_MAP_VERSION = "1.0.0"
TAXONOMIES = ("us-gaap", "ifrs-full")
CONCEPTS = {
    "revenue": ("RevenueFromContractWithCustomerExcludingAssessedTax", "Revenues", "SalesRevenueNet"),
    "gross_profit": ("GrossProfit",),
    "operating_income": ("OperatingIncomeLoss",),
    "pretax_income": (
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItemsNoncontrollingInterest",
        "IncomeLossFromContinuingOperationsBeforeIncomeTaxesMinorityInterestAndIncomeLossFromEquityMethodInvestments",
    ),
    "net_income": ("NetIncomeLoss", "ProfitLoss"),
    "operating_cash_flow": ("NetCashProvidedByUsedInOperatingActivities",),
    "capital_expenditure": (
        "PaymentsToAcquirePropertyPlantAndEquipment", "PaymentsForAdditionsToPropertyPlantAndEquipment",
    ),
    "cash_and_equivalents": (
        "CashAndCashEquivalentsAtCarryingValue", "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
    ),
    "current_assets": ("AssetsCurrent",),
    "current_liabilities": ("LiabilitiesCurrent",),
    "total_assets": ("Assets",),
    "total_liabilities": ("Liabilities",),
    "short_term_debt": ("ShortTermBorrowings", "LongTermDebtCurrent", "ShortTermDebtCurrent"),
    "long_term_debt": ("LongTermDebtNoncurrent", "LongTermDebt"),
    "total_debt": ("LongTermDebtAndFinanceLeaseObligations", "LongTermDebtAndCapitalLeaseObligations"),
    "stockholders_equity": (
        "StockholdersEquity", "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ),
    "goodwill": ("Goodwill",),
    "intangible_assets": ("FiniteLivedIntangibleAssetsNet", "IndefiniteLivedIntangibleAssetsExcludingGoodwill"),
    "shares_basic": ("WeightedAverageNumberOfSharesOutstandingBasic",),
    "shares_diluted": ("WeightedAverageNumberOfDilutedSharesOutstanding",),
    "stock_based_compensation": ("ShareBasedCompensation",),
    "interest_expense": ("InterestExpenseNonOperating", "InterestExpense"),
    "accounts_receivable": ("AccountsReceivableNetCurrent", "AccountsNotesAndLoansReceivableNetCurrent"),
    "inventory": ("InventoryNet",),
}
# Roles of the fields.
SHARE_FIELDS = ("shares_basic", "shares_diluted")
DERIVABLE_FIELDS = (
    "revenue", "gross_profit", "operating_income", "pretax_income", "net_income", "operating_cash_flow",
    "capital_expenditure", "stock_based_compensation", "interest_expense",
)
FLOW_FIELDS = DERIVABLE_FIELDS + SHARE_FIELDS
CORE_FIELDS = (
    "net_income", "operating_cash_flow", "operating_income", "revenue", "stockholders_equity", "total_assets",
)
# Accepted duration in days and target length per fiscal period.
DURATION_DAYS = {"Q1": (45, 130, 91), "Q2": (45, 220, 91), "Q3": (45, 310, 91), "FY": (250, 430, 365)}
YTD_DAYS = 130


def default_concept_map(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """(target, concept, concept_rank) and (taxonomy, taxonomy_rank)."""
    concepts = [(t, c, i) for t, names in CONCEPTS.items() for i, c in enumerate(names)]
    return (
        values_table(spark, "target string, concept string, concept_rank int", concepts),
        values_table(spark, "taxonomy string, taxonomy_rank int", [(t, i) for i, t in enumerate(TAXONOMIES)]),
    )
