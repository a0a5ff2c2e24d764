"""Column lists and constants of the billing data model."""

from __future__ import annotations

# --- Fixed values -------------------------------------------------------------------
# These lists and constants must equal the published data model for the results to match.

# Header of a monthly extract, in file order. A last, empty field follows.
EXTRACT_HEADER = """
MONTH YEAR CIRCLE_CODE CIRCLE_NAME DIVISION_CODE DIVISION_NAME SUBDIV_CODE SUBDIV_NAME
LOCATION_CODE CONSUMER_NO CONSUMER_NAME ADDRESS1 ADDRESS2 CENCUS_CODE TRANS_LOCATION SD_AMOUNT
CONNECTION_DATE POLE_CODE PDC_DATE IND_TYPE SEASONAL_IND SD_AMOUNT_RECEIPT_DATE
SD_AMOUNT_RECEIPT_NO CONTRACT_LOAD TARRIF CYCLE_NO METER_READER_NO BOOK_NO ROUTE_CODE METER_NO
METER_STATUS EDUTY_CODE EDUTY_AMOUNT CONTRACT_DEMAND FEEDER_NO PHASE METER_RENT_TYPE
THEFT_ARREARS LITIGATION_ARREARS FIXED_CHG FUEL_CHG FUSE_CHG CREDIT_ADJUSTMENT DEBIT_ADJUSTMENT
CLOSING_ARREARS CONSUMPTION_UNIT ASSESSMENT_UNIT DPC_AMOUNT RELIEF_AMOUNT ENERGY_CHARGE
BOARD_CHARGE PROV_BILL_AMOUNT PAYMENT_AMOUNT BILL_AMOUNT START_METER END_METER AVG_UNIT
RE_START_READING RE_END_READING RE_CONSUMPTION BILL_DATE DUE_DATE PAYMENT_DATE FEEDER_CODE
FEEDER_NAME VILLAGE_NAME TARRIF_SHORT METER_CHANGE_DATE ADJUSTMENT_UNIT OLD_TARIFF_IND
BILL_DEMAND BILL_TYPE STATUS LAST_PAYDATE PREV_BILL_DATE ACTUAL_DEMAND SOLAR_CONSUMER
SOLAR_AGREEMENT_DATE SOLAR_RATE IMP_CONSUMPTION EXP_CONSUMPTION SOLAR_PURCHASE SOLAR_ADJUSTMENT
AMR_INDICATOR TDS_ADJ SOLAR_LOAD SOLAR_CONN_TYPE GENRATION_UNIT FINAL_MF TOU_CHG
""".split()

EXTRACT_FILE_PATTERN = r"(?i)^512LDG(1[0-2]|[1-9])(\d{4})\.txt$"

NUMERIC_FIELDS = """
MONTH YEAR SD_AMOUNT CONTRACT_LOAD EDUTY_AMOUNT CONTRACT_DEMAND THEFT_ARREARS LITIGATION_ARREARS
FIXED_CHG FUEL_CHG FUSE_CHG CREDIT_ADJUSTMENT DEBIT_ADJUSTMENT CLOSING_ARREARS CONSUMPTION_UNIT
ASSESSMENT_UNIT DPC_AMOUNT RELIEF_AMOUNT ENERGY_CHARGE BOARD_CHARGE PROV_BILL_AMOUNT
PAYMENT_AMOUNT BILL_AMOUNT START_METER END_METER AVG_UNIT RE_START_READING RE_END_READING
RE_CONSUMPTION ADJUSTMENT_UNIT BILL_DEMAND ACTUAL_DEMAND SOLAR_RATE IMP_CONSUMPTION
EXP_CONSUMPTION SOLAR_PURCHASE SOLAR_ADJUSTMENT TDS_ADJ SOLAR_LOAD GENRATION_UNIT FINAL_MF TOU_CHG
""".split()

DATE_FIELDS = """
CONNECTION_DATE PDC_DATE SD_AMOUNT_RECEIPT_DATE BILL_DATE DUE_DATE PAYMENT_DATE
METER_CHANGE_DATE LAST_PAYDATE PREV_BILL_DATE SOLAR_AGREEMENT_DATE
""".split()

DESCRIBED_FIELDS = ["CONSUMPTION_UNIT", "BILL_AMOUNT", "PAYMENT_AMOUNT", "CLOSING_ARREARS", "CONTRACT_LOAD"]
CATEGORY_FIELDS = ["TARRIF", "METER_STATUS", "SOLAR_CONSUMER", "PHASE"]

NONNEGATIVE_FIELDS = """
CONSUMPTION_UNIT CONTRACT_LOAD CONTRACT_DEMAND START_METER END_METER AVG_UNIT RE_START_READING
RE_END_READING RE_CONSUMPTION BILL_DEMAND ACTUAL_DEMAND SOLAR_LOAD IMP_CONSUMPTION
EXP_CONSUMPTION GENRATION_UNIT FINAL_MF
""".split()

# Later date first, earlier date second.
DATE_ORDER_PAIRS = [
    ("DUE_DATE", "BILL_DATE"),
    ("BILL_DATE", "PREV_BILL_DATE"),
    ("BILL_DATE", "CONNECTION_DATE"),
    ("PDC_DATE", "CONNECTION_DATE"),
    ("METER_CHANGE_DATE", "CONNECTION_DATE"),
    ("PAYMENT_DATE", "BILL_DATE"),
]

# Upper-cased, trimmed values that may stand for a missing entry.
MISSING_TOKENS = [
    "", "?", "NA", "N/A", "NULL", "NONE", "-", "-1", "999", "9999", "UNKNOWN", "NAN", "NAT",
    "NIL", "NOT AVAILABLE", "NOT APPLICABLE", "MISSING", "UNDEFINED", "--", "TBD",
]
MISSING_PREFIXES = ["UNKNOWN", "MISSING", "NOT AVAILABLE"]

# Strings a conventional text reader takes as missing.
CONVENTIONAL_NA = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

CONSUMPTION_PREDICTORS = """
current_consumption consumption_lag1 consumption_lag2 consumption_lag3 recent_mean_3 recent_std_3
consumption_trend_3 same_month_last_year target_month contract_load tarrif solar_consumer
""".split()
REVENUE_PREDICTORS = """
payment_ratio_current payment_ratio_lag1 payment_ratio_mean3 payment_delay_current arrears_current
arrears_lag1 arrears_trend current_consumption bill_amount tenure_months tarrif contract_load
""".split()
ANOMALY_PREDICTORS = list(CONSUMPTION_PREDICTORS)

# Nested predictor sets of the four linear models.
LINEAR_LADDER = {
    "MLR-1": CONSUMPTION_PREDICTORS[:4],
    "MLR-2": CONSUMPTION_PREDICTORS[:7],
    "MLR-3": CONSUMPTION_PREDICTORS[:7] + ["same_month_last_year", "target_month"],
    "MLR-4": CONSUMPTION_PREDICTORS[:7]
    + ["same_month_last_year", "target_month", "contract_load", "tarrif", "solar_consumer"],
}
# (trees, depth); None grows the tree out.
FOREST_GRID = [(100, 5), (100, 10), (200, 10), (200, None)]
TREE_DEPTHS = [3, 5, 8, None]
MODEL_SEED = 42

VALID_TARIFFS = ["RGPU", "NRGP", "LTMD", "DTR", "TMP", "GLP.SL", "A2", "GLP"]
VALID_SOLAR = ["Y", "N"]

AT_RISK_RATIO = 0.50
ANOMALY_Z = 2.5
ANOMALY_MIN_HISTORY = 3
ALPHA = 0.05
# --- End of fixed values ------------------------------------------------------------

CATEGORICAL_PREDICTORS = ["tarrif", "solar_consumer"]
MODEL_CATEGORIES = ["tarrif", "solar_consumer", "target_month"]

TARGETS = {
    "consumption": "consumption_next",
    "revenue": "at_risk_next",
    "anomaly": "anomaly_next",
}
PREDICTORS = {
    "consumption": CONSUMPTION_PREDICTORS,
    "revenue": REVENUE_PREDICTORS,
    "anomaly": ANOMALY_PREDICTORS,
}
LABEL_ONLY = [
    "payment_ratio_outcome", "at_risk_current", "anomaly_current", "rule_z_current",
    "prior_mean", "prior_std",
]
