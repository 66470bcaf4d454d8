"""The rules that the SQL uses, kept apart from the package's own files."""

import csv
from pathlib import Path


def _lines(name: str) -> list[list[str]]:
    with open(Path(__file__).parent / "rules" / name, encoding="utf-8", newline="") as file:
        return list(csv.reader(line for line in file if not line.startswith("#")))[1:]


EXACT_ROWS = [tuple(r) for r in _lines("exact.csv")]
KEYWORD_ROWS = [(int(priority), category, word) for priority, category, word in _lines("keywords.csv")]

# --- Fixed values: readable names of study codes -------------------------------
STUDY_ROWS = [
    ("NVLTY/GUM/MINT", "Gum & Mints"),
    ("RTD/TEA/COFFEE", "Ready-to-Drink Beverages"),
    ("HHD SP/DET", "Household Detergents"),
    ("DENTAL NDS", "Dental Needs"),
    ("COSM-EYE", "Eye Cosmetics"),
    ("COSM-FACE", "Face Cosmetics"),
    ("GENERAL GROCERIES", "General Groceries"),
    ("TRAVEL/TRIAL", "Travel Size Items"),
]

# --- Fixed values: texts that stand for "no value" -----------------------------
NULL_ALIASES = ["na", "none", "unknown", "nan", "null", "", "nobusinessunit"]
