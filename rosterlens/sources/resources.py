"""JSON resources of all eight types, made from the driver's tables, and what flattening them must give.

Every field is one expression over the table's key, in SQL that Spark and other engines
read alike; from it follow the JSON text that Spark builds and the value that a flattener
must find, so that a query and its SQL start from the same rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.flatten import NPI
from .projection import raw
from .shared import spread


@dataclass(frozen=True)
class Field:
    """A JSON member: its key, its text (SQL, null: absent), and the flattened columns it gives (name -> SQL)."""

    key: str
    json: str
    gives: dict[str, str]
    present: str


def _lines(expr: str) -> str:
    return f"({expr})"


def text(key: str, column: str | None, expr: str) -> Field:
    return Field(key, f"'\"' || {_lines(expr)} || '\"'", {column: expr} if column else {}, f"({expr}) is not null")


def value(key: str, json: str, present: str = "true") -> Field:
    """A member given as JSON text under a condition."""
    return Field(key, f"case when {present} then '{json}' end", {}, present)


def ref(key: str, column: str, expr: str, k: str) -> Field:
    """A reference, absolute and with a query part where ``k`` is divisible by 5."""
    return Field(key, f"'{{\"reference\":\"' || case when {k} % 5 = 0 then 'https://h.example/fhir/' else '' end || {_lines(expr)} || case when {k} % 5 = 0 then '?v=1' else '' end || '\"}}'", {column: expr}, f"({expr}) is not null")


def refs(key: str, column: str, first: str, second: str, k: str) -> Field:
    """A list of two references and one without a value; one object where ``k`` is divisible by 3."""
    one = f"'{{\"reference\":\"' || {_lines(first)} || '\"}}'"
    two = f"'[' || {one} || ',{{\"reference\":\"' || {_lines(second)} || '\"}},{{}}]'"
    return Field(key, f"case when {k} % 3 = 0 then {one} else {two} end", {column: f"case when {k} % 3 = 0 then {first} else ({first}) || ',' || ({second}) end"}, "true")


def codes(key: str, column: str, first: str, second: str, k: str) -> Field:
    """Concepts with two codes, an empty one and one without codings; one object where ``k % 4 = 1``."""
    one = f"'{{\"coding\":[{{\"code\":\"' || {_lines(first)} || '\"}},{{\"code\":\"\"}}]}}'"
    two = f"'[' || {one} || ',{{\"coding\":[{{\"code\":\"' || {_lines(second)} || '\"}}]}},{{\"text\":\"t\"}}]'"
    return Field(key, f"case when {k} % 4 = 1 then {one} else {two} end", {column: f"case when {k} % 4 = 1 then {first} else ({first}) || ',' || ({second}) end"}, "true")


def flag(k: str) -> Field:
    """``active`` as true, false, the string "false", or absent."""
    return Field("active", f"case {k} % 4 when 0 then 'true' when 1 then 'false' when 2 then '\"false\"' end", {"active": f"case {k} % 4 when 0 then 1 when 1 then 0 when 2 then 0 end"}, f"{k} % 4 <> 3")


def _id(kind: str, expr: str) -> str:
    return f"'{kind}/' || cast({expr} as string)"


def _npi(k: str, most: int, skip: int) -> Field:
    number = f"lpad(cast({k} % {most} as string), 10, '0')"
    found = f"case when {k} % {skip} <> 0 then {number} end"
    return Field("identifier", f"'[{{\"system\":\"x\",\"value\":\"1\"}},{{\"system\":\"{NPI}\",\"value\":\"' || {_lines(found)} || '\"}}]'", {"npi": found}, f"{k} % {skip} <> 0")


def _meta(k: str) -> Field:
    stamp = f"case when {k} % 6 = 0 then '2001-01' else '200' || cast({k} % 3 as string) || '-0' || cast({k} % 9 + 1 as string) || '-01T00:00:00Z' end"
    return Field("meta", f"'{{\"lastUpdated\":\"' || {_lines(stamp)} || '\"}}'", {"updated": f"case when {k} % 6 <> 0 then {stamp} end"}, "true")


S, C, P, O = "s_suppkey", "c_custkey", "p_partkey", "o_orderkey"  # noqa: E741

#: table -> (driver's table, key, resource type, fields)
RESOURCES: dict[str, tuple[str, str, str, tuple[Field, ...]]] = {
    "organization": ("supplier", S, "Organization", (
        _meta(S), text("name", "name", "s_name"), _npi(S, 80, 4), flag(S), ref("partOf", "part_of_ref", f"case when {S} % 4 = 1 then {_id('Organization', f'{S} + 5')} end", S),
        Field("alias", f"case when {S} % 3 = 0 then '[\"A\",\"B\"]' when {S} % 3 = 1 then '[]' end", {"alias": f"case when {S} % 3 = 0 then 'A,B' end"}, f"{S} % 3 <> 2"),
        codes("type", "type_codes", f"case when {S} % 10 = 0 then 'ntwk' else 'prov' end", "'pay'", S), Field("", "null", {"is_network": f"case when {S} % 10 = 0 then 1 else 0 end"}, "false"),
        value("telecom", "[]", f"{S} % 5 <> 0"), value("address", "null", f"{S} % 7 <> 0"),
    )),
    "practitioner": ("customer", C, "Practitioner", (
        _meta(C), _npi(C, 1200, 7), flag(C), value("telecom", "[]", f"{C} % 5 <> 0"),
        Field("name", f"case when {C} % 11 = 0 then '[{{\"text\":\"Dr X\",\"family\":\"X\"}}]' when {C} % 11 = 1 then '[]' when {C} % 11 <> 2 then '[{{\"family\":\"' || c_name || '\",\"given\":[\"G\",\"H\"]}},{{\"family\":\"other\"}}]' end",
              {"family": f"case when {C} % 11 = 0 then 'X' when {C} % 11 > 2 then c_name end", "given": f"case when {C} % 11 > 2 then 'G H' end", "name_text": f"case when {C} % 11 = 0 then 'Dr X' when {C} % 11 > 2 then 'G H ' || c_name end"}, f"{C} % 11 <> 2"),
        Field("qualification", f"case when {C} % 2 = 0 then '[{{\"code\":{{\"coding\":[{{\"code\":\"MD\"}}]}}}},{{\"code\":{{\"coding\":[{{\"code\":\"Q' || cast({C} % 4 as string) || '\"}}]}}}}]' end",
              {"qualification_codes": f"case when {C} % 2 = 0 then 'MD,Q' || cast({C} % 4 as string) end"}, f"{C} % 2 = 0"),
    )),
    "practitioner_role": ("orders", O, "PractitionerRole", (
        _meta(O), ref("practitioner", "practitioner_ref", f"case when {O} % 50 <> 2 then {_id('Practitioner', 'o_custkey')} end", O), ref("organization", "organization_ref", _id("Organization", "(o_custkey % 60) * 2"), O),
        refs("location", "location_refs", _id("Location", f"{O} % 3000"), _id("Location", f"{O} % 70 + 1"), O), refs("healthcareService", "healthcare_service_refs", _id("HealthcareService", f"{O} % 150"), _id("HealthcareService", "o_custkey"), O),
        Field("extension", f"case when {O} % 3 = 1 then '[{{\"url\":\"http://x/plannet-Network\",\"valueReference\":{{\"reference\":\"Organization/' || cast({O} % 40 as string) || '\"}}}},{{\"url\":\"other\",\"valueReference\":{{\"reference\":\"Organization/1\"}}}}]' end",
              {"network_refs": f"case when {O} % 3 = 1 then {_id('Organization', f'{O} % 40')} end"}, f"{O} % 3 = 1"),
        codes("specialty", "specialty_codes", "substring(o_orderpriority, 1, 1)", "'207Q'", O), codes("code", "role_codes", "o_orderstatus", "'prov'", O), flag(O),
    )),
    "location": ("part", P, "Location", (
        _meta(P), text("name", "name", "p_name"), text("status", "status", f"case when {P} % 9 <> 0 then 'active' end"), codes("type", "type_codes", "p_brand", "'HOSP'", P), value("telecom", "[]", f"{P} % 5 <> 0"),
        Field("address", f"case {P} % 4 when 0 then '{{\"line\":[\"1\",\"Main\"],\"city\":\"' || p_brand || '\",\"state\":\"NY\",\"postalCode\":\"12345\",\"country\":\"US\"}}' when 1 then '[{{\"line\":[\"2\"],\"state\":\"ca\"}},{{\"city\":\"other\"}}]' when 2 then '[]' end",
              {"address_line": f"case {P} % 4 when 0 then '1 Main' when 1 then '2' end", "address_city": f"case {P} % 4 when 0 then p_brand end", "address_state": f"case {P} % 4 when 0 then 'NY' when 1 then 'ca' end", "address_postalcode": f"case {P} % 4 when 0 then '12345' end", "address_country": f"case {P} % 4 when 0 then 'US' end"}, f"{P} % 4 <> 3"),
        Field("position", f"case when {P} % 2 = 0 then '{{\"latitude\":' || cast(p_size as string) || ',\"longitude\":\"-' || cast(p_size as string) || '\"}}' end", {"latitude": f"case when {P} % 2 = 0 then cast(p_size as double) end", "longitude": f"case when {P} % 2 = 0 then cast(-p_size as double) end"}, f"{P} % 2 = 0"),
        ref("managingOrganization", "managing_organization_ref", _id("Organization", f"{P} % 130"), P),
    )),
    "healthcare_service": ("part", P, "HealthcareService", (
        _meta(P), text("name", "name", f"case when {P} % 6 <> 1 then p_name end"), ref("providedBy", "provided_by_ref", f"case when {P} % 8 <> 0 then {_id('Organization', f'{P} % 120')} end", P), refs("location", "location_refs", _id("Location", P), _id("Location", f"{P} + 7"), P),
        codes("type", "type_codes", "p_brand", "'T'", P), codes("specialty", "specialty_codes", "'207Q'", f"'S' || cast({P} % 3 as string)", P), codes("category", "category_codes", "'cat'", "p_brand", P), flag(P),
    )),
    "organization_affiliation": ("supplier", S, "OrganizationAffiliation", (
        _meta(S), ref("organization", "organization_ref", _id("Organization", f"{S} % 90"), S), ref("participatingOrganization", "participating_organization_ref", f"case when {S} % 6 <> 0 then {_id('Organization', f'{S} + 1')} end", S),
        refs("network", "network_refs", _id("Organization", f"{S} % 30 * 10"), _id("Organization", f"{S} + 2"), S), refs("location", "location_refs", _id("Location", f"{S} * 2"), _id("Location", f"{S} * 3"), S),
        refs("healthcareService", "healthcare_service_refs", _id("HealthcareService", f"{S} * 5"), _id("HealthcareService", f"{S} * 50"), S), codes("specialty", "specialty_codes", "'A'", "'B'", S), codes("code", "role_codes", f"'r' || cast({S} % 7 as string)", "'agency'", S), flag(S),
    )),
    "insurance_plan": ("customer", C, "InsurancePlan", (
        _meta(C), text("name", "name", f"case when {C} % 12 <> 0 then c_name end"), codes("type", "type_codes", "c_mktsegment", "'medical'", C), ref("ownedBy", "owned_by_ref", _id("Organization", f"{C} % 110"), C), ref("administeredBy", "administered_by_ref", f"case when {C} % 5 <> 4 then {_id('Organization', f'{C} % 75')} end", C),
        refs("coverageArea", "coverage_area_refs", _id("Location", f"{C} % 2500"), _id("Location", f"{C} % 9"), C), refs("network", "network_refs", _id("Organization", f"{C} % 20 * 10"), _id("Organization", f"{C}"), C),
        value("identifier", "[]", f"{C} % 10 <> 0"),
        Field("plan", f"case when {C} % 3 <> 0 then '[{{\"type\":{{\"coding\":[{{\"code\":\"gold\"}}]}}}},{{\"type\":{{\"coding\":[{{\"code\":\"P' || cast({C} % 3 as string) || '\"}}]}}}}]' end", {"plan_type_codes": f"case when {C} % 3 <> 0 then 'gold,P' || cast({C} % 3 as string) end"}, f"{C} % 3 <> 0"),
    )),
    "endpoint_resource": ("part", P, "Endpoint", (
        _meta(P), text("name", "name", "p_name"), text("status", "status", f"case when {P} % 20 <> 0 then 'active' end"), Field("connectionType", f"case when {P} % 4 <> 0 then '{{\"code\":\"hl7-fhir-rest\"}}' end", {"connection_type": f"case when {P} % 4 <> 0 then 'hl7-fhir-rest' end"}, f"{P} % 4 <> 0"),
        text("address", "address", f"'https://e' || cast({P} as string) || '.example/fhir'"), ref("managingOrganization", "managing_organization_ref", _id("Organization", f"{P} % 140"), P), codes("payloadType", "payload_types", "'any'", "p_brand", P),
    )),
}


def resources(spark: SparkSession, sf_dir: str, table: str, rows_a_task: int | None = None) -> DataFrame:
    """(payer_id, source_base_url, resource) of one type; its rows in tasks of so many, if a number is given."""
    source, k, kind, fields = RESOURCES[table]
    rows = raw(spark, sf_dir, source)
    members = [f"'\"resourceType\":\"{kind}\",\"id\":\"' || cast({k} as string) || '\"'", *(f"'\"{f.key}\":' || {f.json}" for f in fields if f.key)]
    return (spread(rows, k, rows_a_task) if rows_a_task else rows).select(
        F.expr(f"concat('payer_', cast({k} % 5 as string))").alias("payer_id"), F.lit("https://h.example/fhir").alias("source_base_url"), F.expr(f"'{{' || concat_ws(',', {', '.join(members)}) || '}}'").alias("resource")
    )


def columns(table: str) -> dict[str, str]:
    """Flattened columns of a type and the SQL of their values over its table; arrays are joined by commas."""
    return {c: e for f in RESOURCES[table][3] for c, e in f.gives.items()}


def present(table: str) -> dict[str, str]:
    """JSON keys of a type and the SQL condition under which a resource has them."""
    return {f.key: f.present for f in RESOURCES[table][3] if f.key}


def expected_sql(table: str) -> str:
    """SELECT of what flattening a type gives: payer_id, id, and its columns as text or numbers."""
    source, k, _, _ = RESOURCES[table]
    own = ", ".join(f"{e} as {c}" for c, e in columns(table).items())
    return f"select 'payer_' || cast({k} % 5 as string) as payer_id, cast({k} as string) as id, {own} from {source}"
