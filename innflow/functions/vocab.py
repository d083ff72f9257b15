"""Fixed vocabularies, formats and reason texts.

Everything in this module is a value that must equal the source system's
contract for results to match (status aliases, parse formats in order,
rejection reasons, column limits). They are stated plainly and kept
together so the expressions in ``normalize`` stay generic.
"""

from __future__ import annotations

# --- fixed values: canonical status words -----------------------------------
BOOKING_STATUSES = ("confirmed", "cancelled", "checked_in", "checked_out", "no_show", "pending")
PAYMENT_STATUSES = ("paid", "failed", "refunded", "pending")
UNKNOWN_STATUS = "unknown"

# --- fixed values: status aliases (lower-cased, stripped text -> canonical) --
BOOKING_STATUS_ALIASES = {
    "confirmed": "confirmed", "conf": "confirmed", "cnf": "confirmed",
    "cancelled": "cancelled", "canceled": "cancelled", "cxl": "cancelled",
    "checked_in": "checked_in", "checked-in": "checked_in", "checked in": "checked_in", "ci": "checked_in",
    "checked_out": "checked_out", "checked-out": "checked_out", "checked out": "checked_out", "co": "checked_out",
    "no_show": "no_show", "no-show": "no_show", "no show": "no_show", "noshow": "no_show", "ns": "no_show",
    "pending": "pending", "pnd": "pending",
}
PAYMENT_STATUS_ALIASES = {
    "paid": "paid", "success": "paid",
    "failed": "failed", "declined": "failed",
    "refunded": "refunded",
    "pending": "pending",
}

# --- fixed values: parse formats, tried in this order (Spark pattern letters) --
# Listed formats of the source system for date and timestamp columns.
DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "M-d-yyyy", "d-MMM-yyyy", "yyyy/M/d")
TIMESTAMP_FORMATS = ("yyyy-M-d H:m:s", "d/M/yyyy H:m", "M-d-yyyy h:m a", "yyyy-M-d")

# Finite stand-in for the source system's free-form last-resort inference:
# a common tail shared by both column kinds, then one list per kind.
COMMON_FALLBACK_FORMATS = (
    "d-M-yyyy", "d-MMMM-yyyy", "yyyyMMdd", "MMMM d, yyyy", "yyyy-M-d'T'H:m:s", "yyyy-M-d H:m",
    "yyyy-M-d H:m:s.S", "yyyy-M-d'T'H:m:sXXX", "yyyy-M-d H:m:sXXX",
    "yyyy-M-d'T'H:m:s.S", "yyyy-M-d'T'H:m:s.SXXX", "yyyy-M-d H:m:s.SXXX", "yyyy-M-d'T'H:m", "yyyy-M-d'T'H:mXXX", "yyyy-M-d H:mXXX",
    "d MMM yyyy", "d MMM yyyy H:m", "d MMM yyyy H:m:s", "MMM d yyyy", "MMM d, yyyy H:m", "MMM d, yyyy H:m:s",
    "d.M.yyyy", "d.M.yyyy H:m", "d.M.yyyy H:m:s", "yyyy.M.d", "yyyy/M/d H:m", "yyyy/M/d H:m:s",
    "d-MMM-yyyy H:m", "d-MMM-yyyy H:m:s", "M/d/yyyy h:m a", "M/d/yyyy h:m:s a", "d/M/yyyy h:m a",
)
DATE_FALLBACK_FORMATS = (
    ("M/d/yyyy",) + COMMON_FALLBACK_FORMATS
    + ("yyyy-M-d H:m:s", "M/d/yyyy H:m", "d/M/yyyy H:m", "M/d/yyyy H:m:s", "d/M/yyyy H:m:s", "M-d-yyyy h:m a")
)
TIMESTAMP_FALLBACK_FORMATS = (
    "M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "d-MMM-yyyy", "yyyy/M/d", "M/d/yyyy H:m",
    "M/d/yyyy H:m:s", "d/M/yyyy H:m:s",
) + COMMON_FALLBACK_FORMATS

# --- fixed values: text that counts as missing after stripping ----------------
MISSING_TEXT = ("", "nan")

# --- fixed values: characters stripped from both ends of text (Python str.strip) --
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: rejection reasons (the quarantine contract) ----------------
R_GUEST_ID = "missing/invalid guest_id"
R_GUEST_NAME = "missing first_name or last_name"
R_PROPERTY_ID = "missing/invalid property_id"
R_ROOM_FIELDS = "missing/invalid room_id, property_id, or capacity"
R_ROOM_PROPERTY = "property_id not found in properties"
R_REQUIRED = "missing/unparseable required field"
R_RES_REFERENCE = "invalid guest_id/property_id/room_id reference"
R_DATES = "check_out_date before check_in_date"
R_BOOKING_STATUS = "unrecognized booking_status value"
R_PAYMENT_RESERVATION = "reservation_id not found in reservations"
R_NEGATIVE = "negative payment amount"
R_PAYMENT_STATUS = "unrecognized payment_status value"
CONTRACT_PREFIX = "warehouse contract: "
R_MALFORMED = "malformed row: wrong number of fields"

# --- fixed values: warehouse column limits (VARCHAR lengths, numeric ranges) ---
VARCHAR_LIMITS = {
    "guests": {"first_name": 100, "last_name": 100, "email": 255, "phone": 50, "country": 100},
    "properties": {"property_name": 255, "city": 100, "country": 100},
    "rooms": {"room_type": 50},
    "reservations": {"reservation_id": 30, "booking_status": 20},
    "payments": {"payment_id": 30, "reservation_id": 30, "payment_method": 30, "payment_status": 20},
}
SMALLINT_MAX = 32767
INTEGER_MIN, INTEGER_MAX = -2147483648, 2147483647
AMOUNT_TYPE = "decimal(10,2)"
