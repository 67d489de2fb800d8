"""World region of a place, from its country code or else from its coordinates."""

import re

from pyspark.sql import Column, SparkSession, functions as F

from newsatlas.functions.parsing import WHITESPACE

NO_REGION = "Sin región"

# The region of each country code. The list mixes two code systems on purpose, and
# NI counts for África only.
REGION_CODES = {
    "Norteamérica": "US CA GL",
    "Latinoamérica y Caribe": "MX CR CS GT HO HN ES SV NU PM PA CU DR HA JM RQ PR",
    "Sudamérica": "BR AR CO VE PE EC CI CHL UY BL BO GY",
    "Europa": "UK GB FR GM DE SP ES2 IT RS RU UP UA PL PO NL BE SZ SW NO FI",
    "Asia": "CH CN JA JP KS KR KN IN PK BG TH VM RP PH ID MY IR IZ IQ IS SA TU AF",
    "África": "EG NI NG SF ZA KE ET SU SD MO MA AG DZ LY TZ",
    "Oceanía": "AS AU NZ PP FJ",
}


# The boxes, in order of precedence; edges count as inside unless written < .
REGION_BOXES = (
    ("lon BETWEEN -170 AND -50 AND lat >= 32", "Norteamérica"),
    ("lon BETWEEN -120 AND -30 AND lat < 32", "Latinoamérica y Caribe"),
    ("lon BETWEEN -90 AND -30 AND lat < 15", "Sudamérica"),
    ("lon BETWEEN -25 AND 60 AND lat BETWEEN 35 AND 75", "Europa"),
    ("lon BETWEEN -20 AND 55 AND lat BETWEEN -35 AND 38", "África"),
    ("lon BETWEEN 25 AND 180 AND lat BETWEEN -10 AND 80", "Asia"),
    ("lon BETWEEN 110 AND 180 AND lat BETWEEN -50 AND 0", "Oceanía"),
)


def _region_sql(country: str, lat: str, lon: str) -> str:
    code = f"upper(trim(BOTH '{WHITESPACE}' FROM {country}))"
    point = {"lat": f"try_cast({lat} AS double)", "lon": f"try_cast({lon} AS double)"}
    by_code = [
        f"WHEN {code} IN ({', '.join(repr(c) for c in codes.split())}) THEN '{name}'"
        for name, codes in REGION_CODES.items()
    ]
    nowhere = f"WHEN isnan({point['lat']}) OR isnan({point['lon']}) THEN '{NO_REGION}'"
    by_box = [
        f"WHEN {re.sub('lat|lon', lambda axis: point[axis.group()], box)} THEN '{name}'"
        for box, name in REGION_BOXES
    ]
    return f"CASE {' '.join([*by_code, nowhere, *by_box])} ELSE '{NO_REGION}' END"


def region_of(country: str, lat: str, lon: str) -> Column:
    """Region name, never NULL. A known code wins; otherwise the first box holding the point.

    The arguments are SQL text, column names as a rule. Codes are looked up by set membership, a hash
    probe per region, where a map literal would be scanned key by key. NaN lies in no box, although
    Spark orders it above all numbers.
    """
    return F.expr(_region_sql(country, lat, lon))


def register_region_function(spark: SparkSession, name: str = "region_from_geo") -> None:
    """Make the region available to SQL. The function is SQL itself, which Catalyst expands in place."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(country STRING, lat DOUBLE, lon DOUBLE) "
        f"RETURNS STRING RETURN {_region_sql('country', 'lat', 'lon')}"
    )
