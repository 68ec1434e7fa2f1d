import pytest

from rowferry.errors import ConfigError, SchemaDriftError
from rowferry.operators import contract, deadletter
from rowferry.operators.mapping import ERRORS
from rowferry.schemas import LONG, TEXT, fields
from rowferry.sinks import tables
from pyspark.sql import types as T

STRICT = fields(False, a=LONG, b=TEXT)


def errors(df):
    return [list(r[ERRORS]) for r in df.collect()]


def test_all_faults_of_a_record(rows):
    df = rows("j STRING", ('{"a":"x"}',), ('{"a":1,"b":"y"}',), ("{",), ('{"a":1.5,"b":null,"c":1}',), ('{"a":"7","b":"y"}',))
    found = contract.read_records(df, "j", STRICT)
    assert errors(found) == [["type:a", "missing:b"], [], ["corrupt"], ["added:c", "type:a", "missing:b"], []]
    assert [r.a for r in found.collect()] == [None, 1, None, None, 7]


def test_validate_columns_that_are_apart(rows):
    df = rows("a STRING, z STRING", ("1", "q"), ("x", "q"), (None, "q"))
    assert errors(contract.validate(df, STRICT)) == [["missing:b"], ["type:a", "missing:b"], ["missing:a", "missing:b"]]


def test_nested_fields(rows):
    schema = T.StructType([T.StructField("p", fields(k=LONG), False), T.StructField("n", LONG, False)])
    df = rows("j STRING", ('{"p":{"k":1},"n":1}',), ('{"p":{"k":1},"n":"x"}',), ('{"p":3,"n":1}',))
    found = contract.read_records(df, "j", schema)
    assert errors(found)[:2] == [[], ["type:n"]] and errors(found)[2] != []
    assert [r.p.k if r.p else None for r in found.collect()][:2] == [1, 1]


def test_halt(rows):
    fine, drifted = rows("j STRING", ('{"a":1,"b":"x"}',)), rows("j STRING", ('{"a":1,"b":"x","c":2}',))
    assert contract.halt_on_drift(fine, "j", STRICT) is fine
    with pytest.raises(SchemaDriftError, match="added:c"):
        contract.halt_on_drift(drifted, "j", STRICT)


def test_inference_merges_types(rows):
    df = rows("j STRING", ('{"a":1,"b":"x","n":{"k":1}}',), ('{"a":2.5,"c":null}',), ("broken",))
    found = contract.infer_schema(df, "j")
    assert found["a"].dataType.simpleString() == "double"
    assert found["b"].dataType == TEXT and found["n"].dataType == fields(k=LONG)
    assert contract.infer_schema(df, "j", first=1).names == ["a", "b", "n"]


def test_inferred_fractions_take_later_records(rows):
    first = rows("j STRING", ('{"a":9.99,"AVOIDED":{"AVOIDED":1.5,"x y":[1.25]},"b`c":null}',))
    schema = contract.infer_schema(first, "j")
    assert schema.names == ["AVOIDED", "a", "b`c"] and schema["AVOIDED"].dataType.names == ["AVOIDED", "x y"]
    later = contract.read_records(rows("j STRING", ('{"a":12.5,"AVOIDED":{"AVOIDED":1234.125}}',)), "j", schema)
    assert later.first()["_errors"] == [] and later.first()["a"] == 12.5


def test_null_and_blank_text_are_broken(rows):
    marked = contract.read_records(rows("j STRING", (None,), ("",), (" ",), ('{"a":1,"b":"x"}',)), "j", STRICT)
    assert sorted(tuple(r["_errors"]) for r in marked.collect()) == [(), ("corrupt",), ("corrupt",), ("corrupt",)]


def test_inference_refuses_maps(rows, monkeypatch):
    monkeypatch.setattr(contract, "MAX_FIELDS", 2)
    with pytest.raises(ConfigError):
        contract.infer_schema(rows("j STRING", ('{"a":1,"b":2,"c":3}',)), "j")


def test_pack_unknown_loses_nothing(rows):
    df = rows("j STRING", ('{"a":1,"b":"x","z":{"q":1},"y":2}',), ('{"a":1,"b":"x"}',))
    found = contract.pack_unknown(df, "j", STRICT).collect()
    assert found[0].payload in ('{"z":"{\\"q\\":1}","y":"2"}', '{"y":"2","z":"{\\"q\\":1}"}') and found[1].payload is None


def test_good_and_bad_are_the_input(rows):
    df = rows("j STRING", *[(t,) for t in ('{"a":1,"b":"x"}', "{", '{"a":"x"}', '{"a":2,"b":"y"}', "")])
    marked = contract.read_records(df, "j", STRICT)
    good, bad = deadletter.split(marked)
    assert good.count() + bad.count() == df.count() and good.count() == 2


def test_target_is_made_once_and_widened(spark, rows, tmp_path):
    spark.sql("DROP TABLE IF EXISTS widen_test")
    old = rows("id INT, `a b` STRING", (1, "x"))
    tables.create_target(old, "widen_test", str(tmp_path / "t"))
    tables.create_target(old, "widen_test", str(tmp_path / "elsewhere"))
    tables.append_widening(old, "widen_test")
    tables.append_widening(rows("`new col` DOUBLE, id INT", (2.5, 2)), "widen_test")
    found = {r.id: tuple(r) for r in spark.table("widen_test").collect()}
    assert found == {1: (1, "x", None), 2: (2, None, 2.5)}


def test_publish_keeps_tags(spark, rows, tmp_path):
    spark.sql("DROP TABLE IF EXISTS published_test")
    tables.publish(rows("id INT", (1,)), "published_test", str(tmp_path / "p"), {"owner": "it's us"}, "a table")
    assert tables.published_tags(spark, "published_test") == {"owner": "it's us"}
    assert [c.name for c in spark.catalog.listColumns("published_test")] == ["id"]


def test_blank_text_is_looked_for_once(rows):
    from plans import plan

    wide = T.StructType([T.StructField(f"c{i}", LONG, False) for i in range(12)])
    assert plan(contract.read_records(rows("j STRING", ("{}",)), "j", wide)).lower().count("trim(") <= 2
