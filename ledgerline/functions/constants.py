"""Fixed values that must equal the reference's for identical results.

FIXED VALUES (kept together, natural order, as plain text):
"""

# --- fixed values: placeholder tokens bound into object names, predicates and queries ---
COUNTRY_PLACEHOLDER = "<COUNTRY_PLACEHOLDER>"
REGION_PLACEHOLDER = "<REGION_PLACEHOLDER>"
VENDOR_PLACEHOLDER = "<VENDOR_PLACEHOLDER>"
COMPONENT_PLACEHOLDER = "<COMPONENT_PLACEHOLDER>"
DATE_TOKEN = "sDateToExec"
DATE_SUFFIX_TOKEN = "datasource_suffix"
COUNTRYKEY_PLACEHOLDER = "@placeholder_countrykey"
FEATUREFLAG_PLACEHOLDER = "@placeholder_featureflag"
CONFIG_VARIABLE = r"\{[A-Za-z0-9._]+\}"

# --- fixed values: record-file layout ---
RECORD_FIELD_SEPARATOR = '|"'

# --- fixed values: record-file rule operators (compared upper-cased) ---
OP_IN = "IN"
OP_NOTIN = "NOTIN"
OP_DATEFORMAT = "DATEFORMAT"
OP_AMOUNTFORMAT = "AMOUNTFORMAT"
OP_INFOTYPECOMBINATIONFORMAT = "INFOTYPECOMBINATIONFORMAT"
OP_HOURSFORMAT = "HOURSFORMAT"
OP_WAGETYPECHECK = "WAGETYPECHECK"
OP_COUNTRYCHECK = "COUNTRYCHECK"
OP_CURRENCYCHECK = "CURRENCYCHECK"
OP_WAGETYPECURRENCYCHECK = "WAGETYPECURRENCYCHECK"
OP_BASELINEQUERY = "BASELINEQUERY"

# --- fixed values: the one date regex the date check knows, and its calendar format ---
DATE_REGEX_FORMATS = {r"^\d{4}\d{2}\d{2}$": "yyyyMMdd"}

# --- fixed values: rule semantics ---
COUNTRY_ERROR_CODE = "E004"          # country-mismatch rules scope with NOT IN instead of IN
HISTORY_SUFFIX = "history"           # table names ending in this are scoped to createddttm = run date
ERROR_TYPE = "Error"                 # only this Type counts as a failure
INGESTION_STAGE = "Ingestion"        # stage name of moved ingestion errors
BASELINE_STAGE = "dag06"             # stage whose rule set also carries baseline-count rules
INGESTION_MOVE_STAGE = "dag02"       # stage that moves ingestion errors into the log
THRESHOLD_NOT_EXCEEDED = "N"         # threshold flag value that lets a country/component through

# --- fixed values: status names ---
STATUS_SUCCESS = "Success"
STATUS_PARTIAL = "Partial"
STATUS_FAILURE = "Failure"

# --- fixed values: rendering ---
TOTAL_LINE_COUNT_TOKEN = "{TotalLineCount}"
PERIOD_START_FUNCTION = "GetPeriodStartDate"
CALCULATED_FILE_NAME = "CalculatedFileName"
FILE_TIMESTAMP_FORMAT = "yyyyMMddHHmmss"

# --- fixed values: validation-log layout (column order of the log table) ---
LOG_COLUMNS = [
    "orchestratorid", "stage", "region", "country", "source", "sourcecomponent", "objectname",
    "errorseverity", "type", "errordescription", "erroridentifier", "createddttm",
    "recordtimestamp", "recommendation",
]

# --- fixed values: error-log file column line and info labels, in file order ---
ERROR_LOG_FILE_COLUMNS = [
    "orchestratorid", "stage", "stagedescription", "region", "country", "source",
    "sourcecomponent", "objectname", "errorseverity", "type", "erroridentifier",
    "createddttm", "recordtimestamp", "errordescription", "recommendation",
]
ERROR_LOG_INFO_LABELS = [
    "Timestamp", "ExecutionDate", "Region", "Country", "DataSource", "DataSource Component",
    "Stage Failure", "G2 vs View Count Failure", "Total Base Record", "Total Failure",
    "Threshold(CutOff%)", "Error(Calculated%)", "Status",
]

# --- fixed values: summary table columns ---
SUMMARY_COLUMNS = [
    "logtimestamp", "executiondate", "orchestratorid", "region", "country", "source",
    "sourcecomponent", "stagefailure", "g2vsviewcountfailure", "totalfailure",
    "thresholdpercentage", "errorpercentage", "status",
]

# --- fixed values: ingestion error log columns copied into the validation log ---
INGESTION_ERROR_COLUMNS = [
    "stage", "region", "country", "source", "sourcecomponent", "objectname",
    "errorseverity", "type", "errordescription",
]
