"""Broad category of an actor from its type codes."""

from pyspark.sql import Column, functions as F

# The type codes of each category, in order of precedence.
CATEGORY_CODES = {
    "Gobierno": "GOV LEG JUD COP SPY",
    "Militar": "MIL",
    "Grupo rebelde": "REB INS SEP",
}


def actor_category(*type_codes: str) -> Column:
    """First category any of the code columns belongs to; NULL when none does."""
    cases = []
    for name, codes in CATEGORY_CODES.items():
        listed = ", ".join(repr(code) for code in codes.split())
        cases.append(f"WHEN {' OR '.join(f'{t} IN ({listed})' for t in type_codes)} THEN '{name}'")
    return F.expr(f"CASE {' '.join(cases)} END")
