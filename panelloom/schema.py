"""Column names, data types and fixed values of the panel."""

from pyspark.sql import types as T

KEY = "Ticker"
TIME = "Date"
SOURCE = "FinancialsSource"

# --- fixed values: they are part of the data and must stay as they are ----------------

PROVIDER_A = "yfinance"
PROVIDER_B = "simFin"
BOTH_PROVIDERS = "yfinance + simFin"

PUBLICATION_DELAY_DAYS = 30
PUBLICATION_TOLERANCE_DAYS = 90

SYMBOL_CHANGES = {
    "ATUS": "OPTU",
    "AXL": "DCH",
    "RLGY": "HOUS",
    "RCII": "UPBD",
    "GPS": "GAP",
    "IIVI": "COHR",
}

PROVIDER_B_NAMES = {
    "Revenue": "Total Revenue",
    "Gross Profit": "Gross Profit",
    "Operating Income (Loss)": "Operating Income",
    "Net Income": "Net Income",
    "Shares (Basic)": "Basic Average Shares",
    "Cash, Cash Equivalents & Short Term Investments": "Cash And Cash Equivalents",
    "Short Term Debt": "Current Debt",
    "Long Term Debt": "Long Term Debt",
    "Total Equity": "Stockholders Equity",
    "Total Assets": "Total Assets",
    "Total Current Assets": "Current Assets",
    "Total Current Liabilities": "Current Liabilities",
    "Total Noncurrent Liabilities": "Total Noncurrent Liabilities",
    "Total Liabilities": "Total Liabilities",
    "Net Cash from Operating Activities": "Operating Cash Flow",
    "Net Cash from Investing Activities": "Investing Cash Flow",
    "Net Cash from Financing Activities": "Financing Cash Flow",
    "Change in Fixed Assets & Intangibles": "Capital Expenditure",
    "Depreciation & Amortization": "Depreciation And Amortization",
}
COMPUTED_LATER = ["EBITDA", "Total Debt", "Free Cash Flow"]

INCOME = [
    "Total Revenue", "Gross Profit", "Operating Income", "Net Income", "EBITDA",
    "Basic Average Shares",
]
BALANCE = [
    "Cash And Cash Equivalents", "Current Debt", "Long Term Debt", "Total Debt",
    "Stockholders Equity", "Total Assets", "Current Assets", "Current Liabilities",
    "Total Noncurrent Liabilities", "Total Liabilities",
]
CASH_FLOW = [
    "Operating Cash Flow", "Investing Cash Flow", "Financing Cash Flow", "Free Cash Flow",
    "Capital Expenditure", "Depreciation And Amortization",
]
STATEMENT_ALIASES = {
    "Total Non Current Liabilities Net Minority Interest": "Total Noncurrent Liabilities",
    "Total Liabilities Net Minority Interest": "Total Liabilities",
}
STATEMENT_METADATA = [
    "SimFinId", "Currency", "Fiscal Year", "Fiscal Period", "Publish Date",
    "Restated Date", "Shares (Basic)", "Shares (Diluted)", "Depreciation & Amortization",
    "Provision for Loan Losses",
]
CRITICAL_METRICS = ["Operating Income", "EBITDA", "Net Income", "Total Assets", "Total Liabilities"]
UNUSED_PRICE_COLUMNS = ["High", "Low", "Capital Gains", "Stock Splits", "Adj Close"]

UNIT_ERRORS = [("IIIN", "2021-12-01", 1000.0)]
UNIT_ERROR_COLUMNS = [
    "CashAndCashEquivalents", "TotalAssets", "StockholdersEquity", "CurrentAssets",
    "CurrentLiabilities",
]
DIMENSION_PATCHES = [
    ("MKSI", "Technology", "Scientific And Technical Instruments"),
    ("WTW", "Financial Services", "Insurance Brokers"),
]

YOY_NEUTRAL = 0.03
QOQ_NEUTRAL = 0.0074
LONG_SHARE = 0.8
GROWTH_LIMIT = 10.0
TRADING_DAYS_PER_MONTH = 21

GROWTH_COLUMNS = [
    "TotalRevenue_TTM", "EBITDA_TTM", "FreeCashFlow_TTM", "CapitalExpenditure_TTM",
    "AverageDailyVolume_Lag1",
]
LOG_COLUMNS = ["DebtToEquity", "CurrentRatio", "MarketCap"]
POWER_COLUMNS = [
    "MonthlyReturn", "TotalRevenue_TTM_QoQ", "FcfToEbitda", "TotalRevenue_TTM_YoY",
    "AverageDailyVolume_Lag1_QoQ", "AverageDailyVolume_Lag1_YoY", "EBITDA_TTM_QoQ",
    "EBITDA_TTM_YoY", "OperatingMargins", "ProfitMargins", "ReturnOnAssets",
    "ReturnOnEquity", "EnterpriseValue", "Variance",
]
POWER_COLUMNS_LATE = ["BookToMarket", "EarningsYield", "AccrualsRatio"]
LOG_COLUMNS_LATE = ["CapExToRevenue"]
CLIP_LIMITS = [
    ("EbitdaYield", -2.0), ("EbitdaYield", 2.0),
    ("EarningsYield", -2.0), ("EarningsYield", 2.0),
    ("RevenueYield", -2.0),
    ("TotalRevenue_TTM_Acceleration", -2.0), ("TotalRevenue_TTM_Acceleration", 2.0),
    ("CapExToRevenue", 1.0),
    ("AccrualsRatio", -1.0), ("AccrualsRatio", 1.0),
]
CLIP_LIMITS_LATE = [
    ("BookToMarket_Yeo", -3.5), ("CapExToRevenue_Log1p", 0.45),
    ("FreeCashFlow_TTM_Acceleration", -10.0), ("FreeCashFlow_TTM_Acceleration", 10.0),
    ("ShortTermBeta", -2.5), ("ShortTermBeta", 5.0),
    ("RevenueYield", -2.5), ("RevenueYield", 7.5),
    ("EarningsYield_Yeo", -5.0), ("EarningsYield_Yeo", 5.0),
]
ROUNDED_RATIOS = [
    "EarningsYield", "BookToMarket", "EbitdaYield", "OperatingMargins", "ProfitMargins",
    "ReturnOnEquity", "ReturnOnAssets", "DebtToEquity", "CurrentRatio",
]
NOT_REQUIRED_FIRST = ["GrossProfit_TTM", "FinancingCashFlow_TTM", "InvestingCashFlow_TTM"]
NOT_REQUIRED_SECOND = ["GrossProfit_TTM"]
WEAK_PREDICTORS = [
    "FreeCashFlow_TTM_QoQ", "CapitalExpenditure_TTM_QoQ",
    "AverageDailyVolume_Lag1_Acceleration", "AverageDailyVolume_Lag1_QoQ_Yeo",
    "CapitalExpenditure_TTM_YoY", "CapExToRevenue_Log1p", "Industry",
]
FOREST = {
    "numTrees": 300, "maxDepth": 4, "minInstancesPerNode": 30, "subsamplingRate": 0.3,
    "featureSubsetStrategy": "0.25", "seed": 42,
}

# --- names derived from the lists above ------------------------------------------------


def squeeze(name):
    """A statement name without its spaces."""
    return name.replace(" ", "")


FLOWS = [squeeze(c) for c in INCOME + CASH_FLOW]
STOCKS = [squeeze(c) for c in BALANCE]
AVERAGED_FLOWS = ["BasicAverageShares"]


def financial_columns(ttm=True):
    """Balance columns, then cash-flow and income columns with their trailing suffix."""
    suffix = "_TTM" if ttm else ""
    flows = [squeeze(c) + suffix for c in CASH_FLOW + INCOME]
    return STOCKS + flows


def flag_columns(df):
    return [c for c in df.columns if "_IsMissing" in c]


def numeric_columns(df, exclude=()):
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


PRICE_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField(TIME, T.DateType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.DoubleType()),
])
SYMBOL_SCHEMA = T.StructType([T.StructField(KEY, T.StringType())])
CONSTITUENT_SCHEMA = T.StructType([
    T.StructField("Symbol", T.StringType()),
    T.StructField("Date added", T.StringType()),
])
