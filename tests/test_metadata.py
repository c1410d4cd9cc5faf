import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snapwright.operators.metadata import (
    flatten_wide,
    is_plain,
    metadata_long,
    metadata_map,
    prepare_metadata,
    serialise,
)

CHUNK = """
 doc_id long, source_filename string, page_number int, chunk_index int, extracted_date timestamp_ntz, checked boolean,
 extracted struct<
  related_service_id:int, service_type:string, city:string, mentioned_services:array<string>,
  contact:struct<phone:string,email:string>,
  service_details:struct<hours:map<string,string>,cost:string,languages:array<string>>>
"""


@pytest.fixture(scope="module")
def chunks(spark):
    moment = datetime(2024, 5, 6, 7, 8, 9, 1000)
    rows = [
        (1, "full.pdf", 3, 0, moment, True,
         (None, "food", "Oakland", ["Pantry", "Kitchen"], ("555-1234", "a@example.org"),
          ({"monday": "9-5", "friday": "10-2"}, "Free", ["English", "Spanish"]))),
        (2, "minimal.pdf", None, 1, None, None, (123, "housing", "Berkeley", None, None, None)),
        (3, "", 1, 0, None, False, (None, "general", None, [], (None, None), ({}, None, []))),
        (4, "none.pdf", None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, CHUNK)


def entries(df):
    found = {}
    for row in metadata_long(df, ["doc_id"]).collect():
        found.setdefault(row.doc_id, {})[row.key] = (row.value, row.value_type)
    return found


def test_full_metadata(chunks):
    got = entries(chunks)[1]
    assert {k: v for k, (v, _) in got.items()} == {
        "source_filename": "full.pdf", "page_number": "3", "chunk_index": "0",
        "extracted_date": "2024-05-06T07:08:09.001000", "checked": "true", "extracted_service_type": "food",
        "extracted_city": "Oakland", "extracted_mentioned_services": '["Pantry","Kitchen"]',
        "extracted_contact_phone": "555-1234", "extracted_contact_email": "a@example.org",
        "extracted_service_details_hours_monday": "9-5", "extracted_service_details_hours_friday": "10-2",
        "extracted_service_details_cost": "Free", "extracted_service_details_languages": '["English","Spanish"]',
    }
    assert got["page_number"][1] == "int" and got["checked"][1] == "bool" and got["extracted_city"][1] == "string"


def test_minimal_metadata(chunks):
    got = entries(chunks)[2]
    assert set(got) == {"source_filename", "chunk_index", "extracted_related_service_id", "extracted_service_type", "extracted_city"}
    assert got["extracted_related_service_id"] == ("123", "int")


def test_empty_collections_vanish_and_empty_text_stays(chunks):
    got = entries(chunks)[3]
    assert set(got) == {"source_filename", "page_number", "chunk_index", "checked", "extracted_service_type"}
    assert got["source_filename"] == ("", "string")
    assert set(entries(chunks)[4]) == {"source_filename"}


def test_times_are_iso_text(chunks):
    wide = flatten_wide(chunks, ["doc_id"])
    value = wide.filter("doc_id = 1").head().extracted_date
    assert isinstance(value, str) and datetime.fromisoformat(value) == datetime(2024, 5, 6, 7, 8, 9, 1000)


def test_everything_is_plain(chunks):
    wide, long = prepare_metadata(chunks, ["doc_id"])
    assert is_plain(wide.schema) and is_plain(long.schema)
    assert wide.filter("doc_id = 1").head().extracted_service_details_hours_friday == "10-2"
    rest = flatten_wide(chunks, ["doc_id"], {"extracted_service_details_hours": ["monday"]}).filter("doc_id = 1").head()
    assert json.loads(rest.extracted_service_details_hours) == {"friday": "10-2"}
    named = flatten_wide(chunks, ["doc_id"], {"extracted_service_details_hours": ["monday", "sunday"]})
    row = named.filter("doc_id = 1").head()
    assert (row.extracted_service_details_hours_monday, row.extracted_service_details_hours_sunday) == ("9-5", None)
    assert named.schema["page_number"].dataType.simpleString() == "int"


def test_map_form_holds_only_present_keys(chunks):
    got = {r.doc_id: r.metadata for r in metadata_map(chunks, ["doc_id"]).collect()}
    assert got[4] == {"source_filename": "none.pdf"}
    assert got[1]["extracted_service_details_hours_friday"] == "10-2"


def test_later_key_wins(spark):
    df = spark.createDataFrame(
        [(1, "first", ("second",), {"b": "third"}), (2, "first", (None,), {}), (3, "first", ("second",), None)],
        "doc_id long, a_b string, a struct<b:string>, a2 map<string,string>",
    )
    wide = {r.doc_id: r.a_b for r in flatten_wide(df, ["doc_id"]).collect()}
    assert wide == {1: "second", 2: "first", 3: "second"}
    renamed = df.select("doc_id", "a_b", F.col("a2").alias("a"))
    got = {r.doc_id: r.metadata["a_b"] for r in metadata_map(renamed, ["doc_id"]).collect()}
    assert got == {1: "third", 2: "first", 3: "first"}


def test_nested_maps(spark):
    df = spark.createDataFrame(
        [(1, {"x": {"y": 1, "z": None}, "w": {}}, {"p": (["q"], None)})],
        "doc_id long, m map<string,map<string,int>>, n map<string,struct<items:array<string>,note:string>>",
    )
    assert entries(df)[1] == {"m_x_y": ("1", "int"), "n_p_items": ('["q"]', "string")}
    wide = flatten_wide(df, ["doc_id"]).head().asDict()
    assert {k: v for k, v in wide.items() if v is not None} == {"doc_id": 1, "m_x_y": 1, "n_p_items": '["q"]'}


def test_serialise(chunks):
    rows = {r.doc_id: r for r in serialise(chunks, ["doc_id"]).collect()}
    outer = json.loads(rows[1].extracted)
    assert outer["service_type"] == "food" and json.loads(outer["mentioned_services"]) == ["Pantry", "Kitchen"]
    assert json.loads(outer["contact"]) == {"phone": "555-1234", "email": "a@example.org"}
    details = json.loads(outer["service_details"])
    assert json.loads(details["hours"]) == {"monday": "9-5", "friday": "10-2"}
    assert json.loads(rows[2].extracted) == {"related_service_id": 123, "service_type": "housing", "city": "Berkeley"}
    assert json.loads(rows[3].extracted) == {"service_type": "general"}
    assert rows[4].extracted is None and rows[3].source_filename == ""


def test_map_keeps_inner_nulls(spark):
    df = spark.createDataFrame([(1, {"a": None, "b": 2}), (2, {})], "doc_id long, m map<string,int>")
    got = {r.doc_id: r.m for r in serialise(df, ["doc_id"]).collect()}
    assert json.loads(got[1]) == {"a": None, "b": 2} and got[2] is None
