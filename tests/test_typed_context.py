"""Context fields of real nested types, and JSON text that repeats keys."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmill.config import NO_CONTEXT_PLACEHOLDER
from chatmill.operators.context import context_fields, resolve_context
from chatmill.plans.prepare import records_of
from chatmill.session import scratch_path
from chatmill.sources import tables
from chatmill.sources.qa_files import read_evidence_qa

from conftest import SF_SMALL

NAMES = ("entity_pages", "evidence", "search_results")


def contexts(df, **how):
    return [r.context for r in resolve_context(df, **how).orderBy("id").collect()]


def typed(spark, schema, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"id int, {schema}")


def as_json(df):
    """The same columns as JSON text; null fields are left out."""
    return df.select("id", *[F.when(F.col(c).isNotNull(), F.to_json(c)).alias(c) if not isinstance(df.schema[c].dataType, T.StringType) else F.col(c) for c in NAMES])


FORMS = [
    ("entity_pages array<struct<wiki_context:string,text:string,other:int>>, evidence array<string>, search_results array<struct<snippet:string,title:string>>",
     [([(None, " T ", 1)], None, None), ([("", "T", 1)], None, None), ([("  ", "T", 1)], ["E"], None), ([], [" E "], None), ([None, (None, "T", 1)], None, None),
      (None, [None, "E"], [("", "H")]), (None, [], [(None, None), ("S", None)]), (None, ["  "], [("S", "H")]), (None, None, None)]),
    ("entity_pages array<map<string,string>>, evidence array<struct<text:string,value:string>>, search_results map<string,array<struct<snippet:string>>>",
     [([{"content": "C", "text": ""}], None, None), ([{}], [("", "V")], None), ([{"x": "y"}], [(None, None)], {"zz": [], "aa": [("S",)]}),
      (None, None, {"zz": [(" ",)], "aa": [("A",)]}), (None, None, {"zz": None}), (None, None, {}), (None, None, {"b": [("B",)], "a": [("A",)]})]),
    ("entity_pages string, evidence array<array<string>>, search_results struct<zz:struct<description:string,title:int>,aa:array<struct<snippet:string>>,s:string>",
     [('[{"text":"J"}]', None, None), (None, [["E"]], ((None, 3), [("A",)], "s")), ("[]", [["E"]], (("D", 1), [("A",)], None)),
      (None, None, (None, None, "s")), ("no json", None, (("", 1), [None, ("A",)], None)), (None, None, None)]),
    ("entity_pages struct<wiki_context:array<string>,text:array<string>>, evidence array<map<string,string>>, search_results map<string,struct<title:string>>",
     [((["W"], ["T"]), None, None), (None, [{"value": "V"}], None), ((["W"], None), [], {"k": ("X",), "j": ("Y",)}), (None, None, {"k": (None,), "j": ("Y",)})]),
]


@pytest.mark.parametrize("schema,rows", FORMS)
def test_typed_and_json_forms_agree(spark, schema, rows):
    df = typed(spark, schema, rows)
    got = contexts(df)
    assert got == contexts(as_json(df))
    assert len(set(got)) > 2
    assert contexts(df, struct_of_arrays=True) == contexts(as_json(df), struct_of_arrays=True)


def test_struct_of_lists_is_no_list(spark):
    schema, rows = FORMS[3]
    df = typed(spark, schema, rows)
    assert contexts(df)[0] == NO_CONTEXT_PLACEHOLDER and contexts(df, struct_of_arrays=True)[0] == "W"


def test_variant_columns(spark):
    rows = ['[{"text":"T"}]', "[]", '[{"wiki_context":5,"text":"T"}]']
    df = spark.createDataFrame(list(enumerate(rows)), "id int, j string").select(
        "id", F.parse_json("j").alias("entity_pages"), F.lit(None).cast("variant").alias("evidence"), F.parse_json(F.lit('{"a":[{"title":"H"}]}')).alias("search_results"))
    assert contexts(df) == ["T", "H", "T"]


def test_parquet_source_with_nested_types(spark):
    path = scratch_path(spark, "typed-test")
    tables.typed_evidence_qa(spark, SF_SMALL, "maps").write.parquet(path)
    df = read_evidence_qa(spark, path, "parquet")
    assert isinstance(df.schema["search_results"].dataType, T.MapType) and isinstance(df.schema["entity_pages"].dataType, T.ArrayType)
    recs = records_of({"trivia_qa": df})
    assert recs.count() == df.where("trim(answer.value) <> '' and trim(question) <> ''").count() > 0
    missing = scratch_path(spark, "typed-missing")
    df.select("question", "answer").write.parquet(missing)
    assert {r.context for r in resolve_context(read_evidence_qa(spark, missing, "parquet")).collect()} == {NO_CONTEXT_PLACEHOLDER}


REPEATED = [
    (('[{"text":"CTX","a":1,"a":2}]', None, None), "CTX"),
    (('[{"text":"A","text":"B"}]', None, None), "B"),
    (('[{"text":"A","text":"  "}]', '["E",{"a":1,"a":2}]', None), "E"),
    (('[{"text":{"x":1,"x":2},"wiki_context":"W"}]', None, None), "W"),
    ((' [{"content":"C"},{"a":1,"a":2}]', None, None), "C"),
    ((None, '[{"text":"","value":"V","value":"U"}]', None), "U"),
    ((None, None, '[{"snippet":"S","a":[1],"a":[2]}]'), "S"),
    ((None, None, '{"zz":[{"snippet":"S","a":1,"a":1}],"aa":{"title":"T"}}'), "S"),
    ((None, None, '{"zz":{"title":""},"aa":{"title":"T"},"zz":{"title":"Z"}}'), "Z"),         # the last value, at the first place
    ((None, None, '{"zz":[],"zz":"text","aa":[{"title":"T"},5]}'), "T"),
    (('[{"text":"A","text":"B"},5]', None, None), "B"),
    (('{"text":"X","text":"Y"}', None, None), NO_CONTEXT_PLACEHOLDER),                         # no list
    (('[{"text":"A","text":"B"', None, None), NO_CONTEXT_PLACEHOLDER),
    (("[{'text':'A','text':'B'}]", None, None), NO_CONTEXT_PLACEHOLDER),
]


def test_repeated_keys_take_the_last_value(spark):
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(REPEATED)], "id int, entity_pages string, evidence string, search_results string")
    assert contexts(df) == [want for _, want in REPEATED]
    for cells, want in REPEATED[:10]:                    # as the usual parser has it
        ep, ev, sr = (json.loads(c) if c else None for c in cells)
        assert want in json.dumps([ep, ev, sr])


def test_tally_of_fields(spark):
    df = spark.createDataFrame([('[{"a":1,"a":2}]', None, "{}"), ("[1]", "x", '{"k":1,"k":2}'), ("[", None, None), ("5", '"s"', "{'k':1}")],
                               "entity_pages string, evidence string, search_results string")
    got = {r.field: tuple(r)[1:] for r in context_fields(df).collect()}
    assert got == {"entity_pages": (4, 0, 2, 1, 1), "evidence": (4, 2, 1, 0, 1), "search_results": (4, 1, 1, 1, 1)}
    assert context_fields(df.limit(0)).count() == 0
