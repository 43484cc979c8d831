"""Flatteners: JSON resources to typed rows, with rejects.

Fields that may be a list, an object or a string are first taken as text (``from_json``
hands a nested value to a STRING field as its JSON text) and then parsed on their own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.bundles import TYPES

NPI = "http://hl7.org/fhir/sid/us-npi"
_C = S.CONCEPT
_FIELDS = (
    "resourceType string, id string, meta struct<lastUpdated:string>, name string, alias array<string>, type string, active string, status string, partOf struct<reference:string>, "
    "identifier array<struct<system:string,value:string>>, qualification array<struct<code:" + _C + ">>, practitioner struct<reference:string>, organization struct<reference:string>, "
    "location string, healthcareService string, network string, specialty string, code string, category string, extension array<struct<url:string,valueReference:struct<reference:string>>>, "
    "address string, position struct<latitude:string,longitude:string>, managingOrganization struct<reference:string>, providedBy struct<reference:string>, "
    "participatingOrganization struct<reference:string>, ownedBy struct<reference:string>, administeredBy struct<reference:string>, coverageArea string, plan array<struct<type:" + _C + ">>, "
    "connectionType struct<code:string>, payloadType string"
)
#: The members that each table's columns are taken from, beside those of all tables.
_OWN = {
    "organization": "name alias type active partOf identifier", "practitioner": "name active identifier qualification",
    "practitioner_role": "active practitioner organization location healthcareService specialty code extension",
    "location": "name status type address position managingOrganization", "healthcare_service": "name providedBy location type specialty category active",
    "organization_affiliation": "organization participatingOrganization network location healthcareService specialty code active",
    "insurance_plan": "name type ownedBy administeredBy coverageArea network plan", "endpoint_resource": "name status connectionType address managingOrganization payloadType",
}
_NAME = "struct<family:string,given:array<string>,text:string>"
_ADDRESS = "struct<line:array<string>,city:string,state:string,postalCode:string,country:string>"


def _fields(table: str | None) -> str:
    """The schema to parse with: all members, or those that one table needs; others are then skipped unread."""
    wanted = ("resourceType", "id", "meta", *_OWN[table].split()) if table else None
    return _FIELDS if wanted is None else ", ".join(f for f in _FIELDS.split(", ") if f.split(" ")[0] in wanted)


def _codes(field: str) -> Column:
    return S.codes(S.as_list(F.col(f"r.{field}"), _C))


def _ref(field: str) -> Column:
    return S.normalize_reference(F.col(f"r.{field}.reference"))


def _active() -> Column:
    return S.bool_int(F.col("r.active"))


def _columns(table: str) -> dict[str, Column]:
    if table == "organization":
        types = _codes("type")
        return {
            "name": F.col("r.name"), "alias": S.nullif_empty(F.col("r.alias")), "type_codes": types,
            "is_network": F.coalesce(F.array_contains(types, "ntwk"), F.lit(False)).cast("int"),
            "npi": S.identifier_value(F.col("r.identifier"), NPI), "active": _active(), "part_of_ref": _ref("partOf"),
        }
    if table == "practitioner":
        names = S.human_name(S.as_list(F.col("r.name"), _NAME))
        return names | {"npi": S.identifier_value(F.col("r.identifier"), NPI), "active": _active(), "qualification_codes": S.codes(F.transform("r.qualification", lambda q: q["code"]))}
    if table == "practitioner_role":
        return {
            "practitioner_ref": _ref("practitioner"), "organization_ref": _ref("organization"), "location_refs": S.refs(F.col("r.location")),
            "healthcare_service_refs": S.refs(F.col("r.healthcareService")), "network_refs": S.network_refs(F.col("r.extension")),
            "specialty_codes": _codes("specialty"), "role_codes": _codes("code"), "active": _active(),
        }
    if table == "location":
        address = F.try_element_at(S.as_list(F.col("r.address"), _ADDRESS), F.lit(1))
        return {
            "name": F.col("r.name"), "status": F.col("r.status"), "address_line": S.address_line(address["line"]), "address_city": address["city"],
            "address_state": address["state"], "address_postalcode": address["postalCode"], "address_country": address["country"],
            "latitude": S.position(F.col("r.position.latitude")), "longitude": S.position(F.col("r.position.longitude")),
            "managing_organization_ref": _ref("managingOrganization"), "type_codes": _codes("type"),
        }
    if table == "healthcare_service":
        return {
            "name": F.col("r.name"), "provided_by_ref": _ref("providedBy"), "location_refs": S.refs(F.col("r.location")), "type_codes": _codes("type"),
            "specialty_codes": _codes("specialty"), "category_codes": _codes("category"), "active": _active(),
        }
    if table == "organization_affiliation":
        return {
            "organization_ref": _ref("organization"), "participating_organization_ref": _ref("participatingOrganization"), "network_refs": S.refs(F.col("r.network")),
            "location_refs": S.refs(F.col("r.location")), "healthcare_service_refs": S.refs(F.col("r.healthcareService")),
            "specialty_codes": _codes("specialty"), "role_codes": _codes("code"), "active": _active(),
        }
    if table == "insurance_plan":
        return {
            "name": F.col("r.name"), "type_codes": _codes("type"), "owned_by_ref": _ref("ownedBy"), "administered_by_ref": _ref("administeredBy"),
            "coverage_area_refs": S.refs(F.col("r.coverageArea")), "network_refs": S.refs(F.col("r.network")), "plan_type_codes": S.codes(F.transform("r.plan", lambda p: p["type"])),
        }
    if table == "endpoint_resource":
        return {
            "name": F.col("r.name"), "status": F.col("r.status"), "connection_type": F.col("r.connectionType.code"), "address": F.col("r.address"),
            "managing_organization_ref": _ref("managingOrganization"), "payload_types": _codes("payloadType"),
        }
    raise ValueError(f"unknown table {table!r}")


RESOURCE_OF = {table: kind for kind, table in TYPES.items()}


def checked(df: DataFrame, table: str | None = None) -> DataFrame:
    """``df(payer_id, source_base_url, resource)`` with the parsed resource, as ``r`` and as a variant, and why a row is rejected (null: it isn't).

    Each text is parsed once: ``inline`` of one struct keeps the optimiser from copying the
    parse into every filter and column that reads a part of it. Where one ``table`` is named,
    only its members are parsed, and rows of other types are neither whole nor all checked.
    """
    once = F.array(F.struct(F.from_json("resource", _fields(table)).alias("r"), F.try_parse_json("resource").alias("variant")))
    parsed = df.select("*", F.inline(once))
    reason = (
        F.when(F.col("variant").isNull(), "bad-json")
        .when(~F.coalesce(F.col("r.resourceType").isin(*RESOURCE_OF.values()), F.lit(False)), "unknown-type")
        .when(F.coalesce(F.col("r.id"), F.lit("")) == "", "missing-id")
    )
    if table in (None, "location"):
        lines = F.try_element_at(S.as_list(F.col("r.address"), _ADDRESS), F.lit(1))["line"]
        located = F.col("r.resourceType") == "Location"
        reason = reason.when(located & (S.bad_position(F.col("r.position.latitude")) | S.bad_position(F.col("r.position.longitude"))), "bad-position").when(located & S.bad_line(lines), "bad-address-line")
    return parsed.withColumn("reason", reason)


def routed(df: DataFrame) -> DataFrame:
    """``checked`` rows with the table they belong to (``rejects`` for rejects) and the hash of their content: all that any table's columns are taken from."""
    rows = checked(df)
    mapping = F.create_map(*(F.lit(x) for pair in TYPES.items() for x in pair))
    name = F.when(F.col("reason").isNotNull(), "rejects").otherwise(F.try_element_at(mapping, F.col("r.resourceType")))
    return rows.withColumns({"table_name": name, "raw_hash": S.variant_hash(F.col("variant"))}).drop("variant")


def typed(rows: DataFrame, table: str, seen_at: datetime) -> DataFrame:
    """The columns of one table, of its parsed rows; the file a row came from stays with it, if it is known."""
    own = [c.alias(n) for n, c in _columns(table).items()]
    return rows.select(
        "payer_id", F.col("r.id").alias("id"), "source_base_url", "resource", "raw_hash",
        S.parse_last_updated(F.col("r.meta.lastUpdated")).alias("meta_last_updated"), F.lit(seen_at).alias("last_seen_at"), *(["file"] if "file" in rows.columns else []), *own,
    )


def flatten(df: DataFrame, table: str, seen_at: datetime) -> DataFrame:
    """Typed rows of one table; rows of other types and rejects are left out."""
    rows = checked(df, table).filter(F.col("reason").isNull() & (F.col("r.resourceType") == RESOURCE_OF[table]))
    return typed(rows.withColumn("raw_hash", S.variant_hash(F.col("variant"))), table, seen_at)


def rejects(df: DataFrame) -> DataFrame:
    return checked(df).filter("reason is not null").select("payer_id", "source_base_url", "resource", "reason")


def reject_summary(df: DataFrame) -> DataFrame:
    """(reason, n) of all rows; reason 'ok' for the good ones."""
    return checked(df).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n"))
