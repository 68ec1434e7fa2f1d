import base64
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from plans import exchanges, plan

from rowferry.config import FieldMapping
from rowferry.errors import ConfigError, TransformError
from rowferry.formats.custom import apply_row_function, parse_custom
from rowferry.formats.parse import CORRUPT, flatten, parse_avro, parse_json
from rowferry.functions.casts import cast_type
from rowferry.operators import filters, mapping, protect
from rowferry.operators.mapping import ERRORS
from rowferry.schemas import DOUBLE, LONG, TEXT, fields

KEY = base64.b64encode(bytes(32)).decode()
OTHER = base64.b64encode(bytes([1]) * 32).decode()


def test_mapper_is_a_projection(rows):
    df = rows("a INT, b STRING, `c.d` STRING", (1, "x", "y"))
    made = mapping.field_mapper(df, [FieldMapping("b", "z"), FieldMapping("nope", "n"), FieldMapping("b", "y"), FieldMapping("c.d", "e.f")])
    assert made.columns == ["z", "y", "e.f"] and made.first() == ("x", "x", "y")


def test_mapper_without_mappings_changes_nothing(rows):
    df = rows("a INT", (1,))
    assert mapping.field_mapper(df, []) is df


def test_mapper_without_any_match_raises(rows):
    with pytest.raises(TransformError):
        mapping.field_mapper(rows("a INT", (1,)), [FieldMapping("b", "c")])


def test_cast_failure_is_an_error_not_a_null_unseen(rows):
    df = rows("v STRING", ("1",), ("x",), (None,))
    made = mapping.field_mapper(df, [FieldMapping("v", "n", "integer")]).collect()
    assert [(r.n, list(r[ERRORS])) for r in made] == [(1, []), (None, ["cast:n"]), (None, [])]


def test_unknown_cast_is_refused():
    with pytest.raises(ConfigError):
        cast_type("uuid")


def test_the_two_null_rules(rows):
    df = rows("id INT, ok BOOLEAN", (1, True), (2, False), (3, None))
    assert [r.id for r in filters.row_filter(df, "ok").collect()] == [1]
    assert [r.id for r in filters.drop_if(df, "ok").collect()] == [2, 3]


def test_filter_needs_a_boolean(rows):
    df = rows("id INT", (1,))
    for column in ("id", "missing"):
        with pytest.raises(TransformError):
            filters.row_filter(df, column)


def test_filter_lets_marked_rows_pass(rows):
    df = rows("ok BOOLEAN, _errors ARRAY<STRING>", (False, ["type:x"]), (False, []), (True, []))
    assert filters.row_filter(df, "ok", spare_errors=True).count() == 2


def test_masks_keep_null(rows):
    df = rows("a STRING, b STRING, c STRING", (None, None, None), ("abc", "abc", "abcdefg"))
    made = protect.mask_partial(protect.mask_redact(protect.mask_hash(df, ["a"]), ["b"]), ["c"]).collect()
    assert tuple(made[0]) == (None, None, None)
    assert made[1].b == "***" and made[1].c == "***defg" and len(made[1].a) == 64


def test_short_values_and_salt(rows):
    df = rows("a STRING", ("ab",))
    assert protect.mask_partial(df, ["a"]).first().a == "ab"
    assert protect.mask_hash(df, ["a"], "s").first() != protect.mask_hash(df, ["a"]).first()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",))), min_size=1, max_size=5))
def test_decrypt_undoes_encrypt(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    opened = protect.decrypt(protect.encrypt(df, ["v"], KEY, "aad"), ["v"], KEY, "aad").collect()
    assert [r.v for r in opened] == values and not any(r[ERRORS] for r in opened)


def test_wrong_key_tag_or_text_is_marked(rows):
    sealed = protect.encrypt(rows("v STRING", ("x",), (None,)), ["v"], KEY, "a")
    for key, aad in ((OTHER, "a"), (KEY, "b")):
        found = protect.decrypt(sealed, ["v"], key, aad).collect()
        assert [list(r[ERRORS]) for r in found] == [["decrypt:v"], []] and found[0].v is None
    assert protect.decrypt(rows("v STRING", ("not base64!",)), ["v"], KEY).first()[ERRORS] == ["decrypt:v"]


def test_same_text_seals_differently(rows):
    df = rows("v STRING", ("x",), ("x",))
    assert protect.encrypt(df, ["v"], KEY).distinct().count() == 2


def test_key_is_not_in_the_plan_text(rows):
    text = plan(protect.encrypt(rows("v STRING", ("x",)), ["v"], KEY))
    assert "aesEncrypt" in text and "0" * 64 not in text


def test_short_key_is_refused(rows):
    with pytest.raises(ConfigError):
        protect.encrypt(rows("v STRING", ("x",)), ["v"], base64.b64encode(b"short").decode())


def test_record_key_tells_null_from_empty(rows):
    df = mapping.with_key(rows("a STRING, b STRING", ("", None), (None, ""), ("", None)), ["a", "b"])
    keys = [r.key for r in df.collect()]
    assert keys[0] == keys[2] != keys[1]


def test_lineage_time_is_given(rows):
    at = datetime(2024, 2, 1, 3, 4, 5)
    assert mapping.add_lineage(rows("a INT", (1,)), "p", "s", at).first()[1:] == ("p", "s", at)


def test_defaults_fit_the_column(rows):
    made = mapping.fill_defaults(rows("a INT, b STRING", (None, None)), {"a": 7, "b": "-", "zz": 1})
    assert made.first() == (7, "-") and made.dtypes == [("a", "int"), ("b", "string")]


def test_chain_is_one_projection_without_shuffle(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet")
    made = mapping.chain(df, [
        lambda d: mapping.field_mapper(d, [FieldMapping("user_id", "account"), FieldMapping("event_type", "kind")]),
        lambda d: filters.drop_if(d, "kind = 'error'"),
        lambda d: protect.mask_hash(d, ["account"]),
    ])
    text = plan(made)
    assert exchanges(made) == 0
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text and "Python" not in text


def test_json_faults_are_marked(rows):
    df = rows("j STRING", ('{"a":1,"b":"x"}',), ('{"a":"x"}',), ('{"a":',))
    found = parse_json(df, "j", fields(a=LONG, b=TEXT)).collect()
    assert [r[CORRUPT] is not None for r in found] == [False, True, True]


def test_json_is_parsed_once_under_a_filter(rows):
    df = parse_json(rows("j STRING", ('{"a":1}',)), "j", fields(a=LONG)).where("a > 0")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_flatten(rows):
    df = rows("a STRUCT<b: INT, c: STRUCT<d: STRING>>, e ARRAY<STRUCT<f: INT>>", (((1, ("x",)), [(1,), (2,)])))
    assert flatten(df).columns == ["a_b", "a_c_d", "e"]
    opened = flatten(df, explode_arrays=True)
    assert opened.columns == ["a_b", "a_c_d", "e_f"] and opened.count() == 2


def test_row_function_failures_stay_alone(rows):
    def halve(row):
        return {"v": "text" if row["v"] == 3 else 10 // row["v"]}

    made = apply_row_function(rows("v BIGINT", (2,), (0,), (3,)), halve, fields(v=LONG)).collect()
    assert [r.v for r in made] == [5, None, None]
    assert made[0]["_error"] is None and "ZeroDivisionError" in made[1]["_error"] and made[2]["_input"] == '{"v": 3}'


def test_custom_parser_gives_several_rows(rows):
    def pieces(text):
        return [{"n": int(p)} for p in text.split(",")]

    made = parse_custom(rows("id INT, t STRING", (1, "1,2"), (2, "x")), "t", pieces, fields(n=LONG), keep=["id"]).collect()
    assert [(r.id, r.n, r["_error"] is None) for r in made] == [(1, 1, True), (1, 2, True), (2, None, False)]


def test_a_parser_may_make_many_rows(rows):
    df = rows("n INT", (25_000,), (0,), (3,))
    made = parse_custom(df, "n", lambda n: [{"v": i} for i in range(n)], fields(v=LONG))
    assert made.count() == 25_003 and made.where("_error IS NOT NULL").count() == 0


def test_avro_without_its_package_says_so(rows):
    from rowferry.errors import ConnectorMissing

    df = rows("b BINARY", (b"x",))
    try:
        parse_avro(df, "b", '{"type":"record","name":"r","fields":[{"name":"a","type":"int"}]}')
    except ConnectorMissing as missing:
        assert "spark-avro" in str(missing)


def test_generator_repeats(spark):
    from rowferry.sources.generate import generate

    wanted = [("n", "integer", 10), ("x", "float", 5), ("t", "text", 4)]
    one, two, other = (generate(spark, 200, wanted, s).orderBy("id").collect() for s in (7, 7, 8))
    assert one == two != other
    assert all(0 <= r.n < 10 and 0 <= r.x < 5 and len(r.t) == 4 for r in one)
    assert generate(spark, 1, [("v", "float", 1)], 1).schema["v"].dataType == DOUBLE
