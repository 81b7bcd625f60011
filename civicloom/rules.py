"""Word lists, rule tables, patterns and thresholds.

Everything in this module is data that decides results, kept apart from logic.
"""

from __future__ import annotations

# --- Silver and marts -------------------------------------------------------

DEFAULT_BOROUGH = "UNSPECIFIED"
UNASSIGNED_PRECINCT = "Unspecified"
CLOSED_STATUS = "CLOSED"
OPEN_STATUSES = ["OPEN", "IN PROGRESS", "PENDING", "ASSIGNED", "STARTED"]
BOROUGHS = ["MANHATTAN", "BROOKLYN", "QUEENS", "BRONX", "STATEN ISLAND"]
MISSING_ZIP = "00000"

# Trailing street abbreviation and its long form.
STREET_SUFFIXES = {
    "ST": "STREET",
    "AVE": "AVENUE",
    "BLVD": "BOULEVARD",
    "DR": "DRIVE",
    "RD": "ROAD",
    "PL": "PLACE",
    "CT": "COURT",
    "LN": "LANE",
    "PKWY": "PARKWAY",
}

# City names that carry no neighbourhood.
GENERIC_CITIES = ["MANHATTAN", "BROOKLYN", "QUEENS", "BRONX", "STATEN ISLAND", "NEW YORK"]

# Neighbourhoods accepted for the one borough that reports them.
NEIGHBORHOODS = {
    "QUEENS": [
        "JAMAICA", "FLUSHING", "ASTORIA", "RIDGEWOOD", "FOREST HILLS", "CORONA",
        "JACKSON HEIGHTS", "ELMHURST", "BAYSIDE", "RICHMOND HILL", "WOODHAVEN",
        "FAR ROCKAWAY", "OZONE PARK", "SOUTH OZONE PARK", "WHITESTONE", "MASPETH",
        "SUNNYSIDE", "WOODSIDE", "FRESH MEADOWS", "HOLLIS", "SAINT ALBANS",
        "QUEENS VILLAGE", "COLLEGE POINT", "BELLEROSE", "REGO PARK", "MIDDLE VILLAGE",
        "HOWARD BEACH", "LONG ISLAND CITY", "EAST ELMHURST", "SPRINGFIELD GARDENS",
        "ROSEDALE", "CAMBRIA HEIGHTS", "LITTLE NECK", "OAKLAND GARDENS",
        "SOUTH RICHMOND HILL", "ARVERNE", "ROCKAWAY BEACH", "KEW GARDENS",
        "GLEN OAKS", "FLORAL PARK", "NEW HYDE PARK",
    ],
}

# Complaint types by risk class; every other type is LOW.
RISK_CLASSES = {
    "HIGH": [
        "HEAT/HOT WATER", "PLUMBING", "PAINT/PLASTER", "DOOR/WINDOW", "WATER LEAK",
        "ELEVATOR", "MOLD", "RODENTS", "UNSANITARY CONDITION", "PEST CONTROL", "LEAD",
        "ASBESTOS", "ELECTRIC", "GAS", "FIRE SAFETY", "STRUCTURAL", "CEILING",
        "FLOORING", "GENERAL CONSTRUCTION",
    ],
    "MEDIUM": [
        "NOISE - RESIDENTIAL", "NOISE - COMMERCIAL", "NOISE - STREET/SIDEWALK", "NOISE",
        "ILLEGAL PARKING", "BLOCKED DRIVEWAY", "SANITATION CONDITION",
        "ILLEGAL DUMPING", "GRAFFITI", "DERELICT VEHICLE",
    ],
}

# Score weights, cap and tier bounds.
SCORE_WEIGHTS = {"total": 2.0, "open": 5.0, "days": 0.5, "anomaly": 10.0, "high": 3.0}
SCORE_CAP = 100.0
TIER_HIGH, TIER_MEDIUM = 70, 40

# Macro series and the column each one fills.
MACRO_SERIES = {
    "UNRATE": "unemployment_rate",
    "CPIAUCSL": "cpi",
    "FEDFUNDS": "fed_funds_rate",
    "GDP": "gdp_billions",
}
SERIES_FILE_PATTERN = r"([A-Z]+)_\d"

# Fixed value: where an ingest with no saved mark starts.
FIRST_MARK = "2020-07-29T19:21:00.000"

# --- Promotion gates --------------------------------------------------------

REQUIRED_GATES = [
    "schema", "data_quality", "validation", "quarantine", "reconciliation", "cost", "security",
]
PROMOTION_GATE = "promotion"
FORECAST_GATE = "trend_forecast"

# Column names that must never be published.
SENSITIVE_NAME_PATTERNS = [
    r"\bssn\b", r"social_security", r"\bpassword\b", r"\bpwd\b", r"api_key", r"secret",
    r"\btoken\b", r"credit_card", r"card_number", r"\bcvv\b", r"passport", r"\bdob\b",
    r"date_of_birth",
]

# Sensitive value patterns, first match wins.
SENSITIVE_VALUE_PATTERNS = {
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "email": r"\b[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\b",
    "credit_card_16": r"\b(?:\d[ -]*?){13,16}\b",
}

# --- Record classification --------------------------------------------------

SEVERITIES = ["info", "low", "medium", "high", "blocking"]

# Defect -> (severity, quarantine, recoverability, meaning).
DEFECT_RULES = {
    "schema_drift": ("high", True, 0.40, "columns or types depart from the contract"),
    "missing_required_field": ("high", True, 0.30, "a field the domain needs is absent"),
    "missing_optional_field": ("low", False, 0.90, "a nice-to-have field is absent"),
    "duplicate_key": ("high", True, 0.60, "the key occurs more than once"),
    "range_violation": ("medium", True, 0.40, "a value lies outside its bounds"),
    "null_validation_status": ("blocking", True, 0.00, "nobody set a validation status"),
    "route_ambiguous": ("high", True, 0.70, "the flight route is not certain"),
    "duration_outlier": ("medium", True, 0.50, "the duration cannot be right"),
    "source_conflict": ("high", True, 0.40, "two sources contradict each other"),
    "referential_integrity_failure": ("blocking", True, 0.00, "the parent row is missing"),
    "reconciliation_failure": ("blocking", True, 0.00, "totals do not add up"),
    "security_exposure": ("blocking", True, 0.00, "private or secret data is visible"),
    "cost_threshold_exceeded": ("medium", False, 0.50, "the output is over its budget"),
}
UNKNOWN_DEFECT = ("medium", True, 0.50)

# Recoverability of a reason code; unlisted codes score 0.5.
RECOVERABILITY = {
    "missing_optional_field": 0.90,
    "route_ambiguous": 0.70,
    "duplicate_key": 0.60,
    "duration_outlier": 0.50,
    "range_violation": 0.40,
    "schema_drift": 0.40,
    "missing_required_field": 0.30,
    "source_conflict": 0.40,
    "missing_origin_or_destination": 0.20,
    "invalid_timestamp_no_payload_hash": 0.10,
    "null_validation_status": 0.00,
    "referential_integrity_failure": 0.00,
    "reconciliation_failure": 0.00,
    "security_exposure": 0.00,
}
UNKNOWN_RECOVERABILITY = 0.50

# Fields each domain must fill, and domains that need a status.
REQUIRED_FIELDS = {
    "complaints": ["complaint_id"],
    "property_risk": ["full_address"],
    "aviation": ["source_system", "callsign", "origin", "destination"],
    "validation_control": ["record_id", "validation_status"],
}
STATUS_REQUIRED = ["validation_control", "aviation"]
MAX_DURATION = 1200

# --- Anomalies and forecasts ------------------------------------------------

MIN_VALUES = 10
ZSCORE_LIMIT, ZSCORE_HIGH = 3.0, 5.0
IQR_FENCE = 1.5

SCORE_COLUMNS = ["property_risk_score", "risk_score", "address_risk_score", "score"]
ADDRESS_COLUMNS = ["full_address", "incident_address", "address"]
ZIP_COLUMNS = ["zip_code", "zipcode", "postal_code"]
BOROUGH_COLUMNS = ["borough", "boro"]

HORIZON_MONTHS = 12
INTERVAL_LEVEL = 0.95
LJUNG_BOX_LAGS = 12
LJUNG_BOX_ALPHA = 0.05
SIC_BAND = 2.0
MIN_MONTHS = 24
