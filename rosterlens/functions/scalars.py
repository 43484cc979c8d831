"""Column functions: references, codes, names, dates, JSON keys, bands and percentages.

Every function takes Columns and returns a Column of built-in expressions. Nulls give
nulls unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONCEPT = "struct<coding:array<struct<system:string,code:string>>,text:string>"
# The states, the federal district and Puerto Rico.
STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL",
    "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT",
    "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI",
    "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC", "PR",
]
# What names are searched by.
INITIALS = list("abcdefghijklmnopqrstuvwxyz0123456789")


def as_list(text: Column, item: str) -> Column:
    """Array of ``item`` from JSON text that holds a list or one object."""
    return F.from_json(text, f"array<{item}>")


def nullif_empty(items: Column) -> Column:
    """``items``, null if there are none; ``nullif`` names its operand once, so a long expression isn't computed twice."""
    return F.nullif(items, F.array().cast("array<string>"))


def normalize_reference(ref: Column) -> Column:
    """Last two path parts of a reference without query and fragment; shorter ones stay as they are ('#x' gives '')."""
    # most references have nothing to cut, and a look for a character costs far less than a pattern
    bare = F.when(F.contains(ref, F.lit("?")) | F.contains(ref, F.lit("#")), F.regexp_replace(ref, "[?#].*$", "")).otherwise(ref)
    single = F.when(F.contains(bare, F.lit("//")), F.regexp_replace(bare, "/{2,}", "/")).otherwise(bare)
    parts = F.btrim(single, F.lit("/"))
    return F.when(F.contains(parts, F.lit("/")), F.substring_index(parts, "/", -2)).otherwise(bare)


def refs(text: Column) -> Column:
    """Normalised references of a list or one object; empty ones dropped, none gives null."""
    items = F.transform(as_list(text, "struct<reference:string>"), lambda x: normalize_reference(x["reference"]))
    return nullif_empty(F.filter(items, lambda x: x.isNotNull() & (x != "")))


def codes(concepts: Column) -> Column:
    """Flat array of non-empty codes, in order, duplicates kept; none gives null."""
    flat = F.flatten(F.transform(concepts, lambda c: F.coalesce(F.transform(c["coding"], lambda k: k["code"]), F.array().cast("array<string>"))))
    return nullif_empty(F.filter(flat, lambda z: z.isNotNull() & (z != "")))


def identifier_value(identifiers: Column, system: str) -> Column:
    """Value of the first identifier of a system."""
    return F.try_element_at(F.filter(identifiers, lambda i: i["system"] == system), F.lit(1))["value"]


def human_name(names: Column) -> dict[str, Column]:
    """family, given and name_text of the first name."""
    first = F.try_element_at(names, F.lit(1))
    given = F.nullif(F.array_join(first["given"], " "), F.lit(""))
    joined = F.nullif(F.concat_ws(" ", given, first["family"]), F.lit(""))
    return {"family": first["family"], "given": given, "name_text": F.coalesce(F.nullif(first["text"], F.lit("")), joined)}


def bool_int(flag: Column) -> Column:
    """1, 0 or null of a boolean; the JSON string "false" counts as false."""
    return flag.try_cast("boolean").cast("int")


def address_line(lines: Column) -> Column:
    return F.array_join(lines, " ")


def bad_line(lines: Column) -> Column:
    """Whether an address line holds a null."""
    return F.coalesce(F.exists(lines, lambda x: x.isNull()), F.lit(False))


def position(value: Column) -> Column:
    return value.try_cast("double")


def bad_position(value: Column) -> Column:
    """Whether a coordinate is there but is no number."""
    return value.isNotNull() & value.try_cast("double").isNull()


def parse_last_updated(text: Column) -> Column:
    """ISO-8601 timestamp, null if it isn't one."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def resource_hash(resource: Column) -> Column:
    """Hash of a JSON text that doesn't depend on the order of keys."""
    return variant_hash(F.try_parse_json(resource))


def variant_hash(parsed: Column) -> Column:
    """``resource_hash`` of a text that is parsed already."""
    return F.sha2(F.to_json(parsed), 256)


def network_refs(extension: Column) -> Column:
    """References held by network extensions."""
    found = F.filter(extension, lambda e: F.lower(e["url"]).like("%network%"))
    items = F.transform(found, lambda e: normalize_reference(e["valueReference"]["reference"]))
    return nullif_empty(F.filter(items, lambda x: x.isNotNull() & (x != "")))


def ref_id(ref: Column) -> Column:
    """The part after the first slash; '' without one."""
    return F.split_part(ref, F.lit("/"), F.lit(2))


def has_key(resource: Column, key: str) -> Column:
    """Whether a JSON object has a top-level key, also with a JSON null; false for null or bad text."""
    return F.coalesce(F.array_contains(F.json_object_keys(resource), key), F.lit(False))


def json_double(text: Column, path: str, most: float | None = None) -> Column:
    value = F.get_json_object(text, path).try_cast("double")
    return value if most is None else F.when(value.isNotNull(), F.least(value, F.lit(most)))


def state_valid(state: Column, states=STATES) -> Column:
    return F.upper(state).isin(list(states))


def zip_valid(code: Column) -> Column:
    return code.rlike("^[0-9]{5}")


def access_tier(auth: Column) -> Column:
    return F.when(auth == "none", "open").when(auth == "public_token", "public-token").otherwise("gated")


def source_family(url: Column, families: dict[str, str]) -> Column:
    """Shared back-end of a URL: the first host pattern that matches, else the host."""
    host = F.try_parse_url(url, F.lit("HOST"))
    out = None
    for pattern, family in families.items():
        out = (F if out is None else out).when(host.rlike(pattern), family)
    return host if out is None else out.otherwise(host)


def score_band(score: Column) -> Column:
    return F.when(score.isNull(), "none").when(score >= 80, "good").when(score >= 55, "mid").otherwise("bad")


def coverage_band(n: Column, coverage: Column) -> Column:
    return F.when(n == 0, "not served").when(coverage.isNull(), "unmeasured").when(coverage >= 90, "high").when(coverage >= 55, "mid").otherwise("low")


def key_slug(key: Column) -> Column:
    """Lower-cased key with underscores, null if it isn't an identifier then."""
    slug = F.regexp_replace(F.lower(F.trim(key)), "-", "_")
    return F.when(slug.rlike("^[a-z_][a-z0-9_]*$"), slug)


def month_start(at: Column) -> Column:
    """First moment of a timestamp's month, in the session's time zone."""
    return F.date_trunc("month", at)


def pct(part: Column, whole: Column) -> Column:
    """100 * part / whole to one decimal, null for a null or zero whole."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 1)


def expectation(extension: Column) -> Column:
    """SHALL, SHOULD or MAY of a capability element."""
    return F.try_element_at(F.filter(extension, lambda e: e["url"].endswith("capabilitystatement-expectation")), F.lit(1))["valueCode"]
