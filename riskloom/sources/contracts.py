"""Fixed values of the credit application table.

Names, types and closed domains come with the public data set and have to be
spelled exactly; the table specs say which statistics each history table gets.
"""

from __future__ import annotations

from riskloom.operators.rollup import RollupSpec

KEY = "SK_ID_CURR"
TARGET = "TARGET"

# ---- fixed values: column types of the application table, in file order
APPLICATION_TYPES: dict[str, str] = {
    "SK_ID_CURR": "int64", "NAME_CONTRACT_TYPE": "object", "CODE_GENDER": "object", "FLAG_OWN_CAR": "object",
    "FLAG_OWN_REALTY": "object", "CNT_CHILDREN": "int64", "AMT_INCOME_TOTAL": "float64", "AMT_CREDIT": "float64",
    "AMT_ANNUITY": "float64", "AMT_GOODS_PRICE": "float64", "NAME_TYPE_SUITE": "object",
    "NAME_INCOME_TYPE": "object", "NAME_EDUCATION_TYPE": "object", "NAME_FAMILY_STATUS": "object",
    "NAME_HOUSING_TYPE": "object", "REGION_POPULATION_RELATIVE": "float64", "DAYS_BIRTH": "int64",
    "DAYS_EMPLOYED": "int64", "DAYS_REGISTRATION": "float64", "DAYS_ID_PUBLISH": "int64", "OWN_CAR_AGE": "float64",
    "FLAG_MOBIL": "int64", "FLAG_EMP_PHONE": "int64", "FLAG_WORK_PHONE": "int64", "FLAG_CONT_MOBILE": "int64",
    "FLAG_PHONE": "int64", "FLAG_EMAIL": "int64", "OCCUPATION_TYPE": "object", "CNT_FAM_MEMBERS": "float64",
    "REGION_RATING_CLIENT": "int64", "REGION_RATING_CLIENT_W_CITY": "int64", "WEEKDAY_APPR_PROCESS_START": "object",
    "HOUR_APPR_PROCESS_START": "int64", "REG_REGION_NOT_LIVE_REGION": "int64",
    "REG_REGION_NOT_WORK_REGION": "int64", "LIVE_REGION_NOT_WORK_REGION": "int64",
    "REG_CITY_NOT_LIVE_CITY": "int64", "REG_CITY_NOT_WORK_CITY": "int64", "LIVE_CITY_NOT_WORK_CITY": "int64",
    "ORGANIZATION_TYPE": "object", "EXT_SOURCE_1": "float64", "EXT_SOURCE_2": "float64", "EXT_SOURCE_3": "float64",
    "APARTMENTS_AVG": "float64", "BASEMENTAREA_AVG": "float64", "YEARS_BEGINEXPLUATATION_AVG": "float64",
    "YEARS_BUILD_AVG": "float64", "COMMONAREA_AVG": "float64", "ELEVATORS_AVG": "float64",
    "ENTRANCES_AVG": "float64", "FLOORSMAX_AVG": "float64", "FLOORSMIN_AVG": "float64", "LANDAREA_AVG": "float64",
    "LIVINGAPARTMENTS_AVG": "float64", "LIVINGAREA_AVG": "float64", "NONLIVINGAPARTMENTS_AVG": "float64",
    "NONLIVINGAREA_AVG": "float64", "APARTMENTS_MODE": "float64", "BASEMENTAREA_MODE": "float64",
    "YEARS_BEGINEXPLUATATION_MODE": "float64", "YEARS_BUILD_MODE": "float64", "COMMONAREA_MODE": "float64",
    "ELEVATORS_MODE": "float64", "ENTRANCES_MODE": "float64", "FLOORSMAX_MODE": "float64",
    "FLOORSMIN_MODE": "float64", "LANDAREA_MODE": "float64", "LIVINGAPARTMENTS_MODE": "float64",
    "LIVINGAREA_MODE": "float64", "NONLIVINGAPARTMENTS_MODE": "float64", "NONLIVINGAREA_MODE": "float64",
    "APARTMENTS_MEDI": "float64", "BASEMENTAREA_MEDI": "float64", "YEARS_BEGINEXPLUATATION_MEDI": "float64",
    "YEARS_BUILD_MEDI": "float64", "COMMONAREA_MEDI": "float64", "ELEVATORS_MEDI": "float64",
    "ENTRANCES_MEDI": "float64", "FLOORSMAX_MEDI": "float64", "FLOORSMIN_MEDI": "float64",
    "LANDAREA_MEDI": "float64", "LIVINGAPARTMENTS_MEDI": "float64", "LIVINGAREA_MEDI": "float64",
    "NONLIVINGAPARTMENTS_MEDI": "float64", "NONLIVINGAREA_MEDI": "float64", "FONDKAPREMONT_MODE": "object",
    "HOUSETYPE_MODE": "object", "TOTALAREA_MODE": "float64", "WALLSMATERIAL_MODE": "object",
    "EMERGENCYSTATE_MODE": "object", "OBS_30_CNT_SOCIAL_CIRCLE": "float64", "DEF_30_CNT_SOCIAL_CIRCLE": "float64",
    "OBS_60_CNT_SOCIAL_CIRCLE": "float64", "DEF_60_CNT_SOCIAL_CIRCLE": "float64",
    "DAYS_LAST_PHONE_CHANGE": "float64", "FLAG_DOCUMENT_2": "int64", "FLAG_DOCUMENT_3": "int64",
    "FLAG_DOCUMENT_4": "int64", "FLAG_DOCUMENT_5": "int64", "FLAG_DOCUMENT_6": "int64", "FLAG_DOCUMENT_7": "int64",
    "FLAG_DOCUMENT_8": "int64", "FLAG_DOCUMENT_9": "int64", "FLAG_DOCUMENT_10": "int64",
    "FLAG_DOCUMENT_11": "int64", "FLAG_DOCUMENT_12": "int64", "FLAG_DOCUMENT_13": "int64",
    "FLAG_DOCUMENT_14": "int64", "FLAG_DOCUMENT_15": "int64", "FLAG_DOCUMENT_16": "int64",
    "FLAG_DOCUMENT_17": "int64", "FLAG_DOCUMENT_18": "int64", "FLAG_DOCUMENT_19": "int64",
    "FLAG_DOCUMENT_20": "int64", "FLAG_DOCUMENT_21": "int64", "AMT_REQ_CREDIT_BUREAU_HOUR": "float64",
    "AMT_REQ_CREDIT_BUREAU_DAY": "float64", "AMT_REQ_CREDIT_BUREAU_WEEK": "float64",
    "AMT_REQ_CREDIT_BUREAU_MON": "float64", "AMT_REQ_CREDIT_BUREAU_QRT": "float64",
    "AMT_REQ_CREDIT_BUREAU_YEAR": "float64",
}

# ---- fixed values: allowed levels of the string columns
DOMAINS: dict[str, list[str]] = {
    "NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"],
    "CODE_GENDER": ["M", "F", "XNA"],
    "FLAG_OWN_CAR": ["N", "Y"],
    "FLAG_OWN_REALTY": ["Y", "N"],
    "NAME_TYPE_SUITE": [
        "Unaccompanied", "Family", "Spouse, partner", "Children", "Other_A", "Other_B", "Group of people",
    ],
    "NAME_INCOME_TYPE": [
        "Working", "State servant", "Commercial associate", "Pensioner", "Unemployed", "Student", "Businessman",
        "Maternity leave",
    ],
    "NAME_EDUCATION_TYPE": [
        "Secondary / secondary special", "Higher education", "Incomplete higher", "Lower secondary",
        "Academic degree",
    ],
    "NAME_FAMILY_STATUS": [
        "Single / not married", "Married", "Civil marriage", "Widow", "Separated", "Unknown",
    ],
    "NAME_HOUSING_TYPE": [
        "House / apartment", "Rented apartment", "With parents", "Municipal apartment", "Office apartment",
        "Co-op apartment",
    ],
    "OCCUPATION_TYPE": [
        "Laborers", "Core staff", "Accountants", "Managers", "Drivers", "Sales staff", "Cleaning staff",
        "Cooking staff", "Private service staff", "Medicine staff", "Security staff", "High skill tech staff",
        "Waiters/barmen staff", "Low-skill Laborers", "Realty agents", "Secretaries", "IT staff", "HR staff",
    ],
    "WEEKDAY_APPR_PROCESS_START": [
        "WEDNESDAY", "MONDAY", "THURSDAY", "SUNDAY", "SATURDAY", "FRIDAY", "TUESDAY",
    ],
    "ORGANIZATION_TYPE": [
        "Business Entity Type 3", "School", "Government", "Religion", "Other", "XNA", "Electricity", "Medicine",
        "Business Entity Type 2", "Self-employed", "Transport: type 2", "Construction", "Housing",
        "Kindergarten", "Trade: type 7", "Industry: type 11", "Military", "Services", "Security Ministries",
        "Transport: type 4", "Industry: type 1", "Emergency", "Security", "Trade: type 2", "University",
        "Transport: type 3", "Police", "Business Entity Type 1", "Postal", "Industry: type 4", "Agriculture",
        "Restaurant", "Culture", "Hotel", "Industry: type 7", "Trade: type 3", "Industry: type 3", "Bank",
        "Industry: type 9", "Insurance", "Trade: type 6", "Industry: type 2", "Transport: type 1",
        "Industry: type 12", "Mobile", "Trade: type 1", "Industry: type 5", "Industry: type 10",
        "Legal Services", "Advertising", "Trade: type 5", "Cleaning", "Industry: type 13", "Trade: type 4",
        "Telecom", "Industry: type 8", "Realtor", "Industry: type 6",
    ],
    "FONDKAPREMONT_MODE": ["reg oper account", "org spec account", "reg oper spec account", "not specified"],
    "HOUSETYPE_MODE": ["block of flats", "terraced house", "specific housing"],
    "WALLSMATERIAL_MODE": ["Stone, brick", "Block", "Panel", "Mixed", "Wooden", "Others", "Monolithic"],
    "EMERGENCYSTATE_MODE": ["No", "Yes"],
}

# ---- fixed values: the application features that enter the model
MAIN_FEATURES: list[str] = [
    "PAYMENT_RATE", "EXT_SOURCE_3", "EXT_SOURCE_PRODUCT", "DAYS_EMPLOYED", "DAYS_ID_PUBLISH", "EXT_SOURCE_2",
    "DAYS_REGISTRATION", "AMT_ANNUITY", "AMT_GOODS_PRICE", "ANNUITY_INCOME_PERCENT", "DAYS_BIRTH", "AMT_CREDIT",
    "DAYS_LAST_PHONE_CHANGE", "YEARS_BIRTH", "REGION_POPULATION_RELATIVE", "CREDIT_INCOME_PERCENT",
    "CODE_GENDER_M", "NAME_EDUCATION_TYPE_ENCODED", "TOTALAREA_MODE", "AMT_REQ_CREDIT_BUREAU_YEAR",
    "AMT_INCOME_TOTAL", "HOUR_APPR_PROCESS_START", "FLAG_OWN_CAR", "NAME_FAMILY_STATUS_Married",
    "NAME_CONTRACT_TYPE_Revolving_loans", "FLAG_DOCUMENT_3", "YEARS_BEGINEXPLUATATION_AVG",
    "REGION_RATING_CLIENT_W_CITY", "YEARS_BEGINEXPLUATATION_MODE", "AMT_REQ_CREDIT_BUREAU_QRT",
    "FLAG_WORK_PHONE", "DEF_30_CNT_SOCIAL_CIRCLE", "DEF_60_CNT_SOCIAL_CIRCLE", "REG_CITY_NOT_LIVE_CITY",
    "YEARS_BEGINEXPLUATATION_MEDI", "OBS_60_CNT_SOCIAL_CIRCLE", "FLOORSMAX_AVG", "OBS_30_CNT_SOCIAL_CIRCLE",
    "NAME_INCOME_TYPE_State_servant", "CNT_FAM_MEMBERS", "CNT_CHILDREN", "FLAG_PHONE",
    "AMT_REQ_CREDIT_BUREAU_MON", "FLAG_OWN_REALTY_Y", "NAME_INCOME_TYPE_Working",
    "NAME_FAMILY_STATUS_Single___not_married", "NAME_HOUSING_TYPE_Office_apartment", "FLOORSMAX_MEDI",
    "WEEKDAY_APPR_PROCESS_START_WEDNESDAY", "FLAG_DOCUMENT_13", "AMT_REQ_CREDIT_BUREAU_WEEK",
    "REGION_RATING_CLIENT", "NAME_INCOME_TYPE_Commercial_associate", "WEEKDAY_APPR_PROCESS_START_MONDAY",
    "FLOORSMAX_MODE", "REG_CITY_NOT_WORK_CITY", "FLAG_DOCUMENT_16", "FLAG_DOCUMENT_11",
    "WEEKDAY_APPR_PROCESS_START_TUESDAY", "NAME_FAMILY_STATUS_Widow",
]

# ---- fixed values: rank of the education levels
EDUCATION_RANKS = {
    "Lower secondary": 0,
    "Secondary / secondary special": 1,
    "Incomplete higher": 2,
    "Higher education": 3,
    "Academic degree": 4,
}

# ---- fixed values: monthly status codes of bureau loans
STATUS_LEVELS = ["C", "X", "0", "1", "2", "3", "4", "5"]

# ---- fixed values: quantile-binned columns
QUANTILE_BINS = {
    "INCOME_QUANTILE_BINS": "AMT_INCOME_TOTAL",
    "CREDIT_QUANTILE_BINS": "AMT_CREDIT",
    "GOODS_PRICE_QUANTILE_BINS": "AMT_GOODS_PRICE",
    "ANNUITY_QUANTILE_BINS": "AMT_ANNUITY",
}

# ---- fixed values: statistics per history table
BUREAU = RollupSpec(KEY, "BUREAU", {
    "DAYS_CREDIT": ["count", "mean", "max", "min", "sum"],
    "CREDIT_DAY_OVERDUE": ["mean", "max", "sum"],
    "DAYS_CREDIT_ENDDATE": ["mean", "max"],
    "AMT_CREDIT_MAX_OVERDUE": ["mean", "max"],
    "AMT_CREDIT_SUM": ["mean", "sum", "max"],
    "AMT_CREDIT_SUM_DEBT": ["mean", "sum", "max"],
    "AMT_CREDIT_SUM_OVERDUE": ["mean", "sum"],
    "DAYS_CREDIT_UPDATE": ["mean"],
    "AMT_ANNUITY": ["mean", "sum", "max"],
})
INSTALMENTS = RollupSpec(KEY, "INSTAL", {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "PAYMENT_PERC": ["mean", "sum", "max", "min"],
    "PAYMENT_DIFF": ["mean", "sum", "max", "min"],
    "AMT_INSTALMENT": ["mean", "sum", "max"],
    "AMT_PAYMENT": ["mean", "sum", "max"],
})
POS_CASH = RollupSpec(KEY, "POS", {
    "MONTHS_BALANCE": ["mean", "max", "min", "count"],
    "SK_DPD": ["mean", "max", "sum"],
    "CNT_INSTALMENT_FUTURE": ["mean", "sum", "min"],
})
CREDIT_CARD = RollupSpec(KEY, "CC", {
    "AMT_BALANCE": ["mean", "sum", "max", "min"],
    "AMT_CREDIT_LIMIT_ACTUAL": ["mean", "sum", "max"],
    "AMT_DRAWINGS_CURRENT": ["mean", "sum", "max"],
    "CNT_INSTALMENT_MATURE_CUM": ["mean", "sum", "max"],
    "SK_DPD": ["mean", "max", "sum"],
})
PREVIOUS = RollupSpec(KEY, "PREV", {
    "AMT_ANNUITY": ["mean", "sum", "max", "min"],
    "AMT_CREDIT": ["mean", "sum", "max", "min"],
    "AMT_GOODS_PRICE": ["mean", "sum", "max"],
    "CNT_PAYMENT": ["mean", "sum"],
    "DAYS_DECISION": ["mean", "max", "min"],
})

# ---- fixed values: column types of the six history tables
HISTORY_TYPES = {
    "bureau": {
        "SK_ID_CURR": "int64", "SK_ID_BUREAU": "int64", "CREDIT_ACTIVE": "object", "CREDIT_CURRENCY": "object",
        "DAYS_CREDIT": "int64", "CREDIT_DAY_OVERDUE": "int64", "DAYS_CREDIT_ENDDATE": "float64",
        "DAYS_ENDDATE_FACT": "float64", "AMT_CREDIT_MAX_OVERDUE": "float64", "CNT_CREDIT_PROLONG": "int64",
        "AMT_CREDIT_SUM": "float64", "AMT_CREDIT_SUM_DEBT": "float64", "AMT_CREDIT_SUM_LIMIT": "float64",
        "AMT_CREDIT_SUM_OVERDUE": "float64", "CREDIT_TYPE": "object", "DAYS_CREDIT_UPDATE": "int64", "AMT_ANNUITY": "float64",
    },
    "bureau_balance": {"SK_ID_BUREAU": "int64", "MONTHS_BALANCE": "int64", "STATUS": "object"},
    "installments_payments": {
        "SK_ID_PREV": "int64", "SK_ID_CURR": "int64", "NUM_INSTALMENT_VERSION": "float64", "NUM_INSTALMENT_NUMBER": "int64",
        "DAYS_INSTALMENT": "float64", "DAYS_ENTRY_PAYMENT": "float64", "AMT_INSTALMENT": "float64", "AMT_PAYMENT": "float64",
    },
    "POS_CASH_balance": {
        "SK_ID_PREV": "int64", "SK_ID_CURR": "int64", "MONTHS_BALANCE": "int64", "CNT_INSTALMENT": "float64",
        "CNT_INSTALMENT_FUTURE": "float64", "NAME_CONTRACT_STATUS": "object", "SK_DPD": "int64", "SK_DPD_DEF": "int64",
    },
    "credit_card_balance": {
        "SK_ID_PREV": "int64", "SK_ID_CURR": "int64", "MONTHS_BALANCE": "int64", "AMT_BALANCE": "float64",
        "AMT_CREDIT_LIMIT_ACTUAL": "int64", "AMT_DRAWINGS_ATM_CURRENT": "float64", "AMT_DRAWINGS_CURRENT": "float64",
        "AMT_DRAWINGS_OTHER_CURRENT": "float64", "AMT_DRAWINGS_POS_CURRENT": "float64", "AMT_INST_MIN_REGULARITY": "float64",
        "AMT_PAYMENT_CURRENT": "float64", "AMT_PAYMENT_TOTAL_CURRENT": "float64", "AMT_RECEIVABLE_PRINCIPAL": "float64",
        "AMT_RECIVABLE": "float64", "AMT_TOTAL_RECEIVABLE": "float64", "CNT_DRAWINGS_ATM_CURRENT": "float64",
        "CNT_DRAWINGS_CURRENT": "int64", "CNT_DRAWINGS_OTHER_CURRENT": "float64", "CNT_DRAWINGS_POS_CURRENT": "float64",
        "CNT_INSTALMENT_MATURE_CUM": "float64", "NAME_CONTRACT_STATUS": "object", "SK_DPD": "int64", "SK_DPD_DEF": "int64",
    },
    "previous_application": {
        "SK_ID_PREV": "int64", "SK_ID_CURR": "int64", "NAME_CONTRACT_TYPE": "object", "AMT_ANNUITY": "float64",
        "AMT_APPLICATION": "float64", "AMT_CREDIT": "float64", "AMT_DOWN_PAYMENT": "float64", "AMT_GOODS_PRICE": "float64",
        "WEEKDAY_APPR_PROCESS_START": "object", "HOUR_APPR_PROCESS_START": "int64", "FLAG_LAST_APPL_PER_CONTRACT": "object",
        "NFLAG_LAST_APPL_IN_DAY": "int64", "RATE_DOWN_PAYMENT": "float64", "RATE_INTEREST_PRIMARY": "float64",
        "RATE_INTEREST_PRIVILEGED": "float64", "NAME_CASH_LOAN_PURPOSE": "object", "NAME_CONTRACT_STATUS": "object",
        "DAYS_DECISION": "int64", "NAME_PAYMENT_TYPE": "object", "CODE_REJECT_REASON": "object", "NAME_TYPE_SUITE": "object",
        "NAME_CLIENT_TYPE": "object", "NAME_GOODS_CATEGORY": "object", "NAME_PORTFOLIO": "object", "NAME_PRODUCT_TYPE": "object",
        "CHANNEL_TYPE": "object", "SELLERPLACE_AREA": "int64", "NAME_SELLER_INDUSTRY": "object", "CNT_PAYMENT": "float64",
        "NAME_YIELD_GROUP": "object", "PRODUCT_COMBINATION": "object", "DAYS_FIRST_DRAWING": "float64", "DAYS_FIRST_DUE": "float64",
        "DAYS_LAST_DUE_1ST_VERSION": "float64", "DAYS_LAST_DUE": "float64", "DAYS_TERMINATION": "float64",
        "NFLAG_INSURED_ON_APPROVAL": "float64",
    },
}

# ---- fixed values: rules on the application table
REQUIRED_COLUMNS = [
    "SK_ID_CURR", "TARGET", "AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "CODE_GENDER",
    "DAYS_BIRTH", "DAYS_EMPLOYED", "NAME_EDUCATION_TYPE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3",
]
MIN_ROWS = 1000
#: strings with fewer levels than this are encoded one by one
ENCODED_BELOW_LEVELS = 10
MIN_COLUMNS = 101
DEFAULT_RATE_RANGE = (0.05, 0.35)

# ---- fixed values: readable feature labels, short and report style
SHORT_LABELS = {
    "PAYMENT_RATE": "annuity-to-credit ratio (payment rate)",
    "EXT_SOURCE_2": "external credit score 2",
    "EXT_SOURCE_3": "external credit score 3",
    "EXT_SOURCE_PRODUCT": "combined external credit score",
    "DAYS_EMPLOYED": "employment duration (days)",
    "DAYS_BIRTH": "applicant age (days)",
    "YEARS_BIRTH": "applicant age (years)",
    "ANNUITY_INCOME_PERCENT": "annuity as % of income",
    "CREDIT_INCOME_PERCENT": "credit amount as % of income",
    "AMT_CREDIT": "requested credit amount",
    "AMT_INCOME_TOTAL": "declared annual income",
    "AMT_ANNUITY": "loan annuity amount",
    "AMT_GOODS_PRICE": "goods price",
    "DAYS_ID_PUBLISH": "days since ID was issued",
    "DAYS_REGISTRATION": "days since address registration",
    "DAYS_LAST_PHONE_CHANGE": "days since last phone change",
    "REGION_POPULATION_RELATIVE": "region population density",
    "BUREAU_DAYS_CREDIT_MAX": "most recent credit bureau enquiry (days)",
    "BUREAU_DAYS_CREDIT_MIN": "oldest credit bureau enquiry (days)",
    "BUREAU_AMT_CREDIT_SUM_DEBT_MEAN": "average outstanding bureau debt",
    "BUREAU_AMT_CREDIT_SUM_MEAN": "average bureau credit limit",
    "INSTAL_PAYMENT_PERC_MEAN": "average instalment payment percentage",
    "INSTAL_PAYMENT_DIFF_MEAN": "average instalment shortfall",
    "POS_SK_DPD_MAX": "max days-past-due (POS loans)",
    "POS_CNT_INSTALMENT_FUTURE_MEAN": "average remaining instalments",
    "CODE_GENDER_M": "gender (male)",
    "NAME_EDUCATION_TYPE_ENCODED": "education level",
    "FLAG_OWN_CAR": "car ownership flag",
    "NAME_FAMILY_STATUS_Married": "marital status (married)",
    "TOTALAREA_MODE": "apartment area mode",
}
REPORT_LABELS = {
    "PAYMENT_RATE": "Payment Rate (Annuity/Credit)",
    "EXT_SOURCE_2": "External Credit Score 2",
    "EXT_SOURCE_3": "External Credit Score 3",
    "EXT_SOURCE_PRODUCT": "Combined External Score",
    "DAYS_EMPLOYED": "Employment Duration",
    "DAYS_BIRTH": "Applicant Age (Days)",
    "YEARS_BIRTH": "Applicant Age (Years)",
    "ANNUITY_INCOME_PERCENT": "Annuity / Income Ratio",
    "CREDIT_INCOME_PERCENT": "Credit / Income Ratio",
    "AMT_CREDIT": "Credit Amount",
    "AMT_INCOME_TOTAL": "Annual Income",
    "AMT_ANNUITY": "Loan Annuity",
    "AMT_GOODS_PRICE": "Goods Price",
    "DAYS_ID_PUBLISH": "Days Since ID Issued",
    "DAYS_REGISTRATION": "Days Since Registration",
    "DAYS_LAST_PHONE_CHANGE": "Days Since Phone Change",
    "REGION_POPULATION_RELATIVE": "Region Population Density",
    "BUREAU_DAYS_CREDIT_MAX": "Most Recent Bureau Enquiry",
    "BUREAU_DAYS_CREDIT_MIN": "Oldest Bureau Enquiry",
    "BUREAU_AMT_CREDIT_SUM_DEBT_MEAN": "Avg Outstanding Debt (Bureau)",
    "BUREAU_AMT_CREDIT_SUM_MEAN": "Avg Bureau Credit Limit",
    "INSTAL_PAYMENT_PERC_MEAN": "Avg Instalment Payment %",
    "INSTAL_PAYMENT_DIFF_MEAN": "Avg Instalment Shortfall",
    "POS_SK_DPD_MAX": "Max Days Past Due (POS)",
    "CODE_GENDER_M": "Gender: Male",
    "FLAG_OWN_CAR": "Owns Car",
    "TOTALAREA_MODE": "Property Area",
}
