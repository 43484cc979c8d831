from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rosterlens.functions import scalars as S


def one(spark, column, **values):
    row = spark.range(1).select(*(F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items()) or [F.lit(1).alias("_")])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("Practitioner/1", "Practitioner/1"), ("https://h/fhir/Location/9?x=1#f", "Location/9"), ("#p1", ""), ("urn:uuid:x", "urn:uuid:x"),
        ("https://h/Location/9/_history/2", "_history/2"), (None, None), ("", ""), ("Location/", "Location/"),
    ],
)
def test_normalize_reference(spark, given, want):
    assert one(spark, S.normalize_reference(F.lit(given).cast("string"))) == want


def test_refs_take_lists_and_objects(spark):
    assert one(spark, S.refs(F.lit('[{"reference":"A/1"},{},{"reference":"#x"},{"reference":"h/B/2"}]'))) == ["A/1", "B/2"]
    assert one(spark, S.refs(F.lit('{"reference":"A/1"}'))) == ["A/1"]
    assert one(spark, S.refs(F.lit("[]"))) is None


def test_codes_keep_order_and_duplicates(spark):
    text = '[{"coding":[{"code":"b"},{"code":""},{"code":"a"}]},{"text":"x"},null,{"coding":[{"code":"b"}]}]'
    assert one(spark, S.codes(S.as_list(F.lit(text), S.CONCEPT))) == ["b", "a", "b"]


def test_hash_ignores_key_order(spark):
    a, b = (one(spark, S.resource_hash(F.lit(t))) for t in ('{"a":1,"b":{"c":2,"d":3}}', '{"b":{"d":3,"c":2},"a":1}'))
    assert a == b and one(spark, S.resource_hash(F.lit("{"))) is None


def test_key_with_json_null_exists(spark):
    assert one(spark, S.has_key(F.lit('{"k":null}'), "k")) is True
    assert one(spark, S.has_key(F.lit('{"j":1}'), "k")) is False
    assert one(spark, S.has_key(F.lit(None).cast("string"), "k")) is False


def test_dates_need_a_day(spark):
    assert one(spark, S.parse_last_updated(F.lit("2024-01-02T03:04:05Z"))) == datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, S.parse_last_updated(F.lit("2025-01"))) is None
    assert one(spark, S.parse_last_updated(F.lit("x"))) is None


def test_bands_and_slugs(spark):
    assert [one(spark, S.score_band(F.lit(v).cast("double"))) for v in (None, 80.0, 79.9, 54.9)] == ["none", "good", "mid", "bad"]
    assert one(spark, S.coverage_band(F.lit(0), F.lit(99.0))) == "not served"
    assert one(spark, S.key_slug(F.lit(" My-Key "))) == "my_key" and one(spark, S.key_slug(F.lit("9x"))) is None
    assert one(spark, S.source_family(F.lit("https://a.b.example/x"), {"example$": "shared"})) == "shared"
    assert one(spark, S.source_family(F.lit("https://a.b.org/x"), {"example$": "shared"})) == "a.b.org"
    assert len(set(S.STATES)) == 52 and len(S.INITIALS) == 36


def test_percentages(spark):
    assert one(spark, S.pct(F.lit(1), F.lit(3))) == 33.3 and one(spark, S.pct(F.lit(1), F.lit(0))) is None
