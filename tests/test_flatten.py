import json
from datetime import datetime

from pyspark.sql import functions as F

from rosterlens.functions import scalars as S
from rosterlens.operators import flatten as f

SEEN = datetime(2024, 1, 1)


def rows(spark, *resources):
    return spark.createDataFrame([("p", "https://h", r if isinstance(r, str) else json.dumps(r)) for r in resources], "payer_id string, source_base_url string, resource string")


def flat(spark, table, resource):
    return f.flatten(rows(spark, resource), table, SEEN).first()


def test_practitioner(spark):
    r = flat(spark, "practitioner", {
        "resourceType": "Practitioner", "id": "1", "active": True, "meta": {"lastUpdated": "2024-05-01T00:00:00Z"},
        "name": [{"family": "F", "given": ["A", "B"]}], "identifier": [{"system": "x", "value": "0"}, {"system": f.NPI, "value": "9"}],
        "qualification": [{"code": {"coding": [{"code": "MD"}]}}],
    })
    assert (r.family, r.given, r.name_text, r.npi, r.active, r.qualification_codes) == ("F", "A B", "A B F", "9", 1, ["MD"])


def test_organization_network(spark):
    r = flat(spark, "organization", {"resourceType": "Organization", "id": "1", "name": "N", "type": [{"coding": [{"code": "ntwk"}]}], "partOf": {"reference": "h/Organization/2"}})
    assert (r.is_network, r.type_codes, r.part_of_ref, r.alias) == (1, ["ntwk"], "Organization/2", None)


def test_role(spark):
    r = flat(spark, "practitioner_role", {
        "resourceType": "PractitionerRole", "id": "1", "practitioner": {"reference": "Practitioner/1"}, "location": {"reference": "Location/3"},
        "extension": [{"url": "http://x/plannet-Network", "valueReference": {"reference": "Organization/n"}}],
    })
    assert (r.practitioner_ref, r.location_refs, r.network_refs, r.organization_ref) == ("Practitioner/1", ["Location/3"], ["Organization/n"], None)


def test_every_table_flattens(spark):
    for table, kind in f.RESOURCE_OF.items():
        assert flat(spark, table, {"resourceType": kind, "id": "1"}).id == "1"


def test_rejects(spark):
    bad = rows(
        spark, "{", {"resourceType": "Location"}, {"resourceType": "Basic", "id": "1"}, {"resourceType": "Location", "id": "1", "position": {"latitude": "", "longitude": ""}},
        {"resourceType": "Location", "id": "2", "address": {"line": ["a", None]}}, {"resourceType": "Location", "id": "3", "address": [{"line": ["a"]}]},
    )
    got = {r.reason: r.n for r in f.reject_summary(bad).collect()}
    assert got == {"bad-json": 1, "missing-id": 1, "unknown-type": 1, "bad-position": 1, "bad-address-line": 1, "ok": 1}
    assert f.rejects(bad).count() == 5


def test_one_table_parses_its_own_members_only(spark):
    df = spark.createDataFrame([("p", "u", '{"resourceType":"PractitionerRole","id":"1","address":5,"name":[{}],"location":{"reference":"Location/2"}}')], "payer_id string, source_base_url string, resource string")
    rows = f.flatten(df, "practitioner_role", datetime(2024, 1, 1))
    assert rows.first().location_refs == ["Location/2"]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "coverageArea" not in plan and "healthcareService" in plan


def test_references_with_little_to_cut(spark):
    odd = ["", "/", "//", "a", "a/b", "x//a//b", "/a/b/", "https://h/a/b?x=1#y", "#p", "?q", "a/b#", "a?x\ny/z", "a#\n", "//?", "a/b/?c//d", None]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    bare = F.regexp_replace("x", "[?#].*$", "")
    parts = F.btrim(F.regexp_replace(bare, "/{2,}", "/"), F.lit("/"))
    plain = F.when(F.contains(parts, F.lit("/")), F.substring_index(parts, "/", -2)).otherwise(bare)
    assert all(r.a == r.b for r in df.select(S.normalize_reference(F.col("x")).alias("a"), plain.alias("b")).collect())
