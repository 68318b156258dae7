"""Value maps and bucketing, and the place rules of the location entity."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# State names with their two-letter codes.
STATE_CODES = {
    "Delhi": "DL",
    "Maharashtra": "MH",
    "Uttar Pradesh": "UP",
    "Gujarat": "GJ",
    "Rajasthan": "RJ",
    "Kerala": "KL",
    "Punjab": "PB",
    "Karnataka": "KA",
    "Madhya Pradesh": "MP",
    "Odisha": "OR",
    "Chandigarh": "CH",
    "West Bengal": "WB",
    "Sikkim": "SK",
    "Andhra Pradesh": "AP",
    "Assam": "AS",
    "Jammu and Kashmir": "JK",
    "Puducherry": "PY",
    "Uttarakhand": "UK",
    "Himachal Pradesh": "HP",
    "Tamil Nadu": "TN",
    "Goa": "GA",
    "Telangana": "TG",
    "Chhattisgarh": "CG",
    "Jharkhand": "JH",
    "Bihar": "BR",
}
UNKNOWN_STATE = "xx"
STATE_RENAMES = {"Delhi": "New Delhi"}

# Union territories, capital cities and city tiers.
UNION_TERRITORIES = ("Delhi", "Chandigarh", "Puducherry", "Jammu and Kashmir")
CAPITALS = {"Delhi": "New Delhi", "Maharashtra": "Mumbai"}
TIER_1 = ("Mumbai", "Delhi", "Bengaluru", "Hyderabad", "Chennai", "Kolkata", "Pune", "Ahmedabad")
TIER_2 = (
    "Jaipur", "Lucknow", "Kanpur", "Nagpur", "Indore", "Bhopal", "Patna", "Vadodara", "Coimbatore",
    "Ludhiana", "Agra", "Nashik", "Ranchi", "Meerut", "Raipur", "Guwahati", "Chandigarh",
)


def map_values(c: Column, mapping: Mapping[str, str], default: Column | str) -> Column:
    """Look a value up in a small fixed map; ``default`` when it is not there."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), c)
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def flag_members(c: Column, members: Iterable[str]) -> Column:
    """``Y`` for a listed value, ``N`` for any other, NULL included."""
    return F.when(c.isin(*members), F.lit("Y")).otherwise(F.lit("N"))


def flag_pairs(a: Column, b: Column, pairs: Mapping[str, str]) -> Column:
    """True where ``(a, b)`` is one of the listed pairs."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), a) == b, F.lit(False))


def tier(c: Column, tiers: Mapping[str, Iterable[str]], default: str) -> Column:
    """Name of the first tier that lists the value."""
    names = {value: name for name, values in reversed(tiers.items()) for value in values}
    return map_values(c, names, default)


def state_code(state: Column) -> Column:
    return map_values(state, STATE_CODES, UNKNOWN_STATE)


def state_name(state: Column) -> Column:
    return map_values(state, STATE_RENAMES, state)


def union_territory(state: Column) -> Column:
    return flag_members(state, UNION_TERRITORIES).cast("boolean")


def capital_city(state: Column, city: Column) -> Column:
    return flag_pairs(state, city, CAPITALS)


def city_tier(city: Column) -> Column:
    return tier(city, {"Tier-1": TIER_1, "Tier-2": TIER_2}, "Tier-3")
