import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from zephyrload.functions import measures
from zephyrload.functions.records import number_or_null, page_number, row_key, zone_letter
from zephyrload.plans import bronze
from zephyrload.schemas import SAVED_RESPONSE, conform
from zephyrload.sources.landing import landing_rows, read_saved_responses


def one(spark, value, expression, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression(F.col("x"))).first()[0]


def test_row_key_fills_missing_parts(spark):
    df = spark.createDataFrame([("2026-07-01T04", None, "AA"), (None, None, None)], "a string, b string, c string")
    got = [r[0] for r in df.select(row_key(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [hashlib.md5(t.encode()).hexdigest() for t in ("2026-07-01T04--AA", "--")]


@pytest.mark.parametrize("code, letter", [("ZONJ", "J"), ("ZONN", ""), ("XYZ", None), (None, None), ("NAB", "AB"), ("ZONANB", "A")])
def test_zone_letter(spark, code, letter):
    assert one(spark, code, zone_letter) == letter


@pytest.mark.parametrize(
    "text, number",
    [("12.5", 12.5), (" -3 ", -3.0), ("1e3", 1000.0), (".5", 0.5), ("M", None), ("", None), ("1d", None), (None, None), ("0x1", None)],
)
def test_number_or_null(spark, text, number):
    assert one(spark, text, number_or_null) == number


def test_page_numbers(spark):
    assert [one(spark, o, page_number, "bigint") for o in (0, 4999, 5000, 10000)] == [1, 1, 2, 3]


def response(offset, status, body, hour="2026-07-01T04"):
    return {"run_id": "r", "request_timestamp": "2026-07-01T05:00:00Z", "target_dt": hour, "offset_start": offset,
            "status_code": status, "status": "OK" if status == 200 else "Error", "body": body}


def record(**fields):
    base = {"period": "2026-07-01T04", "subba": "ZONJ", "subba-name": "zone j", "parent": "AA",
            "parent-name": "area", "value": "12.5", "value-units": "megawatthours"}
    return {**base, **fields}


def envelope(*records):
    return json.dumps({"response": {"data": list(records)}})


def responses(spark, *items):
    text = spark.createDataFrame([(json.dumps(i),) for i in items], "t string")
    return text.select(F.from_json("t", SAVED_RESPONSE).alias("r")).select("r.*")


def test_landing_rows(spark, tmp_path):
    items = [response(0, 200, envelope(record(), record())), response(5000, 500, "busy"), response(0, 200, "{}", "h2")]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, items)))
    landed = landing_rows(read_saved_responses(spark, str(tmp_path)))
    assert rows(landed, "target_dt", "page", "status_code", "error_msg", "record_count") == [
        ("2026-07-01T04", 1, 200, "None", 2), ("2026-07-01T04", 2, 500, "busy", 0), ("h2", 1, 200, "None", 0),
    ]
    empty = hashlib.md5(b"{}").hexdigest()
    assert [r[0] == empty for r in landed.orderBy("target_dt", "page").select("response_hash").collect()] == [False, True, True]


def test_hash_ignores_key_order(spark):
    bodies = ['{"a": 1, "b": [1, 2]}', '{"b":[1,2],"a":1}', '{"a": 1, "b": [2, 1]}']
    hashes = [r[0] for r in landing_rows(responses(spark, *[response(0, 200, b) for b in bodies])).select("response_hash").collect()]
    assert hashes[0] == hashes[1] != hashes[2]


def test_bronze_feed(spark):
    landed = landing_rows(
        responses(spark, response(0, 200, envelope(record(), record(value=7), record(value=None), record(subba=None))), response(0, 500, "x"))
    )
    typed = bronze.bronze_feed(landed, bronze.SUBREGION_DEMAND)
    assert typed.count() == 4 == landed.agg(F.sum("record_count")).first()[0]
    assert sorted(r[0] or 0 for r in typed.select("value_mwh").collect()) == [0, 7.0, 12.5, 12.5]
    keys = {r.sub_ba_code: r.srd_id for r in typed.collect()}
    assert keys[None] == hashlib.md5(b"2026-07-01T04--AA").hexdigest()
    assert keys["ZONJ"] == hashlib.md5(b"2026-07-01T04-ZONJ-AA").hexdigest()


def test_bad_value_fails_or_is_null(spark):
    landed = landing_rows(responses(spark, response(0, 200, envelope(record(value="abc")))))
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        bronze.bronze_feed(landed, bronze.SUBREGION_DEMAND).collect()
    assert bronze.bronze_feed(landed, bronze.SUBREGION_DEMAND, strict=False).first().value_mwh is None


def test_malformed_payload(spark):
    bad = responses(spark, response(0, 200, "{no json"))
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING|Malformed"):
        landing_rows(bad).collect()
    assert landing_rows(bad, strict=False).first().record_count == 0


def test_measures(spark):
    df = spark.createDataFrame([(-3.2,), (65.0,), (70.5,), (None,)], "t double")
    t = F.col("t")
    got = df.select(
        measures.heating_degree_days(t), measures.cooling_degree_days(t), measures.band_low(t),
        measures.band_label(measures.band_low(t)), measures.uplift_percent(t, F.lit(0.0)),
    ).collect()
    assert [tuple(r) for r in got] == [
        (68.2, 0.0, -5, "-5-0F", None), (0.0, 0.0, 65, "65-70F", None), (0.0, 5.5, 70, "70-75F", None),
        (None, None, None, None, None),
    ]
    assert one(spark, 0.125, measures.rounded, "double") == 0.13
    assert [one(spark, h, measures.is_complete, "bigint") for h in (22, 23, 25)] == [False, True, True]


def test_conform_orders_casts_and_comments(spark):
    df = spark.createDataFrame([("5", "r", 1)], "offset_start string, run_id string, extra int")
    from zephyrload.schemas import _columns

    schema = _columns(("run_id", "string", "load run"), ("offset_start", "bigint", "first"))
    out = conform(df, schema)
    assert out.dtypes == [("run_id", "string"), ("offset_start", "bigint")]
    assert out.schema["run_id"].metadata == {"comment": "load run"}
