"""The attendance fact table: declared schema, grain and named field sets.

The fact table holds one row per (period, geographic level, region, local
authority, school type). Its schema is declared, never inferred: inference
costs a second pass over the input and turns a column holding a suppression
marker into a string.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source dataset's vocabulary and the
# report definitions for results to be right; they are data, not logic.
# ---------------------------------------------------------------------------

# Geographic levels used by the reports.
NATIONAL = "National"
REGIONAL = "Regional"
LOCAL_AUTHORITY = "Local authority"
LEVELS = [NATIONAL, REGIONAL, LOCAL_AUTHORITY]

# School types, in report order (ties between types resolve in this order).
TOTAL = "Total"
SCHOOL_TYPES = ["Total", "Special", "State-funded secondary", "State-funded primary"]

# The eight named field sets: source column -> output alias, in output order.
FIELD_SETS: dict[str, dict[str, str]] = {
    "enrolments": {
        "enrolments": "enrolments",
    },
    "authorized": {
        "sess_authorised": "absences",
        "sess_auth_illness": "illness",
        "sess_auth_appointments": "appointments",
        "sess_auth_religious": "religious",
        "sess_auth_study": "study",
        "sess_auth_traveller": "traveller",
        "sess_auth_holiday": "holiday",
        "sess_auth_ext_holiday": "ext_holiday",
        "sess_auth_excluded": "excluded",
        "sess_auth_other": "other",
        "sess_auth_totalreasons": "total_reasons",
        "sess_authorised_pa_10_exact": "pa",
    },
    "authorized_percent": {
        "sess_authorised_percent": "absences_percent",
        "sess_authorised_percent_pa_10_exact": "pa_percent",
    },
    "overall": {
        "sess_overall": "absences",
        "sess_overall_pa_10_exact": "pa",
        "sess_overall_totalreasons": "total_reasons",
    },
    "overall_percent": {
        "sess_overall_percent": "absences_percent",
        "sess_overall_percent_pa_10_exact": "pa_percent",
    },
    "possible_sessions": {
        "sess_possible": "possible_sessions",
        "sess_possible_pa_10_exact": "possible_pa",
    },
    "unauthorized": {
        "sess_unauthorised": "absences",
        "sess_unauth_late": "late",
        "sess_unauth_holiday": "holiday",
        "sess_unauth_other": "other",
        "sess_unauth_totalreasons": "total_reasons",
        "sess_unauthorised_pa_10_exact": "pa",
    },
    "unauthorized_percent": {
        "sess_unauthorised_percent": "absences_percent",
        "sess_unauthorised_percent_pa_10_exact": "pa_percent",
    },
}

# Absence reasons for the "main reason" finding: label -> column, in list
# order (a tie goes to the earlier entry).
MAIN_REASONS: list[tuple[str, str]] = [
    ("Illness", "sess_auth_illness"),
    ("Medical Appointments", "sess_auth_appointments"),
    ("Religious Observance", "sess_auth_religious"),
    ("Study Leave", "sess_auth_study"),
    ("Traveller Absence", "sess_auth_traveller"),
    ("Authorised Holiday", "sess_auth_holiday"),
    ("Exclusions", "sess_auth_excluded"),
    ("Other Authorised", "sess_auth_other"),
    ("Unauthorised Holiday", "sess_unauth_holiday"),
    ("Late Arrival", "sess_unauth_late"),
    ("Other Unauthorised", "sess_unauth_other"),
    ("No Reason Yet", "sess_unauth_noyet"),
]

# Comparison blocks of two places: (metric label, column, kind). Kind "rate"
# carries a better/worse indicator (lower is better); "count" carries none.
BASIC_METRICS: list[tuple[str, str, str]] = [
    ("Number of Schools", "num_schools", "count"),
    ("Number of Pupils", "enrolments", "count"),
    ("Total Sessions", "sess_possible", "count"),
    ("Overall Absence Rate (%)", "sess_overall_percent", "rate"),
    ("Authorised Absence Rate (%)", "sess_authorised_percent", "rate"),
    ("Unauthorised Absence Rate (%)", "sess_unauthorised_percent", "rate"),
    ("Persistent Absentees (%)", "enrolments_pa_10_exact_percent", "rate"),
]
# Reasons reported as a share of possible sessions.
AUTHORISED_METRICS: list[tuple[str, str]] = [
    ("Illness (%)", "sess_auth_illness"),
    ("Medical Appointments (%)", "sess_auth_appointments"),
    ("Religious Observance (%)", "sess_auth_religious"),
    ("Study Leave (%)", "sess_auth_study"),
    ("Traveller Absence (%)", "sess_auth_traveller"),
    ("Authorised Holiday (%)", "sess_auth_holiday"),
    ("Exclusions (%)", "sess_auth_excluded"),
    ("Other Authorised (%)", "sess_auth_other"),
]
UNAUTHORISED_METRICS: list[tuple[str, str]] = [
    ("Unauthorised Holiday (%)", "sess_unauth_holiday"),
    ("Late Arrival (%)", "sess_unauth_late"),
    ("Other Unauthorised (%)", "sess_unauth_other"),
    ("No Reason Yet (%)", "sess_unauth_noyet"),
]

# ---------------------------------------------------------------------------
# Declared schema of the 39 columns the reports read.
# ---------------------------------------------------------------------------

GRAIN = ["time_period", "geographic_level", "region_name", "la_name", "school_type"]

COUNT_COLUMNS = [
    "num_schools", "enrolments", "enrolments_pa_10_exact",
    "sess_possible", "sess_overall", "sess_authorised", "sess_unauthorised",
    "sess_overall_totalreasons", "sess_auth_totalreasons", "sess_unauth_totalreasons",
    "sess_possible_pa_10_exact", "sess_overall_pa_10_exact",
    "sess_authorised_pa_10_exact", "sess_unauthorised_pa_10_exact",
    "sess_auth_illness", "sess_auth_appointments", "sess_auth_religious",
    "sess_auth_study", "sess_auth_traveller", "sess_auth_holiday",
    "sess_auth_ext_holiday", "sess_auth_excluded", "sess_auth_other",
    "sess_unauth_late", "sess_unauth_holiday", "sess_unauth_other", "sess_unauth_noyet",
]

RATE_COLUMNS = [
    "enrolments_pa_10_exact_percent",
    "sess_overall_percent", "sess_authorised_percent", "sess_unauthorised_percent",
    "sess_overall_percent_pa_10_exact", "sess_authorised_percent_pa_10_exact",
    "sess_unauthorised_percent_pa_10_exact",
]

FACT = T.StructType(
    [
        T.StructField("time_period", T.IntegerType()),
        T.StructField("geographic_level", T.StringType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("la_name", T.StringType()),
        T.StructField("school_type", T.StringType()),
    ]
    + [T.StructField(c, T.LongType()) for c in COUNT_COLUMNS]
    + [T.StructField(c, T.DoubleType()) for c in RATE_COLUMNS]
)

FACT_COLUMNS = [f.name for f in FACT.fields]


def field_set(name: str) -> dict[str, str]:
    """Return the named field set, or raise ``ValueError`` for an unknown name."""
    try:
        return FIELD_SETS[name]
    except KeyError:
        raise ValueError(f"unknown field set {name!r}; known: {sorted(FIELD_SETS)}") from None
