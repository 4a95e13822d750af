"""Column names, feature lists and fixed lookup values.

Everything a user would tune lives here as plain data and is passed into the
operators as parameters; the operators never read globals on their own.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Columns of the survey / model tables
# ---------------------------------------------------------------------------
ID = "respondent_id"
DATE = "date_flight_local"
SNAPSHOT = "insert_date_ci"
FLIGHT = "surveyed_flight_number"
CABIN = "cabin_in_surveyed_flight"
HAUL = "haul"
CARRIER = "operating_airline_code"
SCORE = "nps_100"
WEIGHT = "monthly_weight"
OTP = "otp15_takeoff"
PROMOTER = "promoter_binary"
DETRACTOR = "detractor_binary"
LABELS = [PROMOTER, DETRACTOR]

# Touchpoint scores present in the derived survey (0-10, nullable).
TOUCHPOINTS = ["pfl_100_checkin", "ifl_300_cabin", "ifl_600_wifi"]
# Numeric (mean-aggregated) and binary features.
NUMERIC_FEATURES = ["ticket_price", "load_factor"]
BINARY_FEATURES = [OTP]
# Model features, in the order the explanation tables use.
FEATURES = NUMERIC_FEATURES + BINARY_FEATURES + TOUCHPOINTS

# Segment columns of every explanation / NPS table.
SEGMENT = [CABIN, HAUL]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
# Eligibility: operating carriers kept, excluded invite group, kept invite group.
ELIGIBLE_CARRIERS = ["IB", "YW"]
EXCLUDED_INVITEGROUP_IB = 3
KEPT_INVITEGROUP = 2
# Haul relabel: medium haul is reported as short haul.
HAUL_REPLACE = {"MH": "SH"}
# Late flag threshold in minutes (flag = 1 when delay > 15).
LATE_MINUTES = 15
# NPS buckets on the 0-10 answer: promoter > 8, detractor <= 6.
PROMOTER_ABOVE = 8
DETRACTOR_AT_MOST = 6
# Touchpoint satisfied when the answer is >= 8.
SATISFIED_FROM = 8
# Cabin label -> load factor column suffix.
CABIN_LF = {"Business": "business", "Premium Economy": "premium_ec", "Economy": "economy"}
# Wi-Fi answer groups and business journey reasons.
WIFI_FAILED = ["Could not get it to work", "No - I could not get it to work"]
WIFI_USED = ["Yes", "Yes, but not enough"]
BUSINESS_REASONS = ["Business", "Business/work"]
# Date cut used by the before/after indicator.
DATE_CUT = "2020-03-13"
# Residence country groups (ISO-2 codes), checked in this order; unmatched -> Others.
COUNTRY_GROUPS = {
    "ESP": ["ES"],
    "EUR": ["AT", "BE", "CH", "DE", "FR", "GB", "UX", "GR", "IL", "IT", "MA", "NL", "PT", "RU", "SE",
            "CZ", "DZ", "IE", "SI", "AD", "DK", "FI", "HR", "HU", "LU", "PL", "RO", "SK", "MC", "EE",
            "NO", "SN"],
    "AM_NOR": ["CA", "MX", "PR", "US"],
    "LATAM": ["CR", "CU", "DO", "GT", "NI", "PA", "SV", "VE", "HN", "AR", "BR", "CL", "CO", "EC", "PE",
              "UY", "BO"],
}
COUNTRY_OTHER = "Others"
# Direction of each feature's effect on NPS: names containing these words are
# expected to push NPS down (-1); touchpoints and the late flag up (+1).
NEGATIVE_DIRECTION_WORDS = ["load_factor", "price", "delay"]
# Study years: floor and excluded years of the production filter, and the
# one comparison that skips the excluded years (2022 compares with 2019).
# On the driver's tables the analogue is floor 1996, excluded 1998/1999,
# 2000 compares with 1997.
YEAR_FLOOR = 1996
EXCLUDED_YEARS = [1998, 1999]
# Confidence tiers by uncertainty quantiles.
TIER_QUANTILES = (0.5, 0.85)
TIER_LABELS = ("High", "Medium", "Low")
# Virtual-ensemble step (models at T/2, T/2+K, ... < T).
ENSEMBLE_STEP = 5
# Champion gate: metrics compared with the champion, minimum gain, floors.
GATE_COMPARE = {"recall": 0.05}
GATE_FLOORS = {"auc": 0.9, "recall": 0.8, "precision": 0.2, "accuracy": 0.8, "f1": 0.25}
GATE_MAX_GAP = 0.05
GATE_MAX_TRAIN = 0.97


def base_year(year: int, excluded=EXCLUDED_YEARS) -> int:
    """Previous comparable year: skip back over excluded years."""
    y = year - 1
    while y in excluded:
        y -= 1
    return y
