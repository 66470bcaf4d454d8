"""Fixed values of the feed format and of its cleaning rules."""

# --- Fixed values: feed format -------------------------------------------------
FEED_SEPARATOR = "|"
PROMO_MARK = "PROMO"
HEADER_CELL = "PLN"
WEEK_OFFSET = 19000000
SEGMENT_PREFIX = "NoSegment-"

# --- Fixed values: row tags ----------------------------------------------------
HEADER_POLLUTION = "Header Pollution"
MISSING_KEYS = "Missing Critical Keys"
VALID = "Valid"

# Tag of our own for lines that have no place in the columns.
MALFORMED = "Malformed Line"

# --- Fixed values: texts that stand for "no value" -----------------------------
NULL_ALIASES = ["na", "none", "unknown", "nan", "null", "", "nobusinessunit"]

# --- Fixed values: fillers -----------------------------------------------------
NO_PROMO = "N"
UNKNOWN = "Unknown"
OTHER = "Other"
UNMAPPED = "Other / Miscellaneous"
HIDDEN_CATEGORIES = ["Other", "Unknown", "Uncategorized"]

# --- Fixed values: readable names of operational study codes -------------------
OPSTUDY_NAMES = {
    "NVLTY/GUM/MINT": "Gum & Mints",
    "RTD/TEA/COFFEE": "Ready-to-Drink Beverages",
    "HHD SP/DET": "Household Detergents",
    "DENTAL NDS": "Dental Needs",
    "COSM-EYE": "Eye Cosmetics",
    "COSM-FACE": "Face Cosmetics",
    "GENERAL GROCERIES": "General Groceries",
    "TRAVEL/TRIAL": "Travel Size Items",
}

# --- Fixed values: the characters of the Unicode White_Space property ----------
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
