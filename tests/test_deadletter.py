import glob
import json
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowferry.config import DeadLetters
from rowferry.errors import ConfigError
from rowferry.formats.custom import apply_row_function
from rowferry.functions.records import name
from rowferry.operators import contract, deadletter
from rowferry.schemas import LONG, TEXT, fields

AT = datetime(2024, 2, 1, 12)
STRICT = fields(False, a=LONG, b=TEXT)


@pytest.fixture
def letters(rows):
    df = rows("j STRING", ('{"a":1,"b":"x"}',), ("{",), ('{"a":"x","b":"y"}',), ('{"b":"z"}',))
    _, bad = deadletter.split(contract.read_records(df, "j", STRICT))
    return deadletter.to_dlq(bad, "p", AT, original=name("j"), metadata={"source": F.lit("s")})


def test_envelope(letters):
    assert letters.columns == [f.name for f in deadletter.DEAD_LETTER.fields]
    found = {r.original_data: r for r in letters.collect()}
    assert found["{"].error_category == "source_parsing_error"
    assert found['{"b":"z"}'].error_message == "missing:a" and found['{"b":"z"}'].error_category == "schema_validation"
    assert found["{"].metadata == {"retry_count": "0", "source": "s"} and found["{"].timestamp == AT


def test_ids_repeat_on_replay(letters):
    ids = [r.id for r in letters.orderBy("id").collect()]
    assert ids == [r.id for r in letters.orderBy("id").collect()] and len(set(ids)) == 3


def test_category_names():
    assert deadletter.category("sink_write_error") == "sink_error"
    assert deadletter.category("deserialization_error") == "source_parsing_error"
    assert deadletter.category("network_error") == "network_error"
    with pytest.raises(ConfigError):
        deadletter.category("bad")


@pytest.mark.parametrize("error,kind", [
    ("corrupt", "source_parsing_error"), ("missing:a", "schema_validation"), ("added:a", "schema_validation"),
    ("type_changed:a", "schema_validation"), ("cast:a", "transformation_error"), ("decrypt:a", "transformation_error"),
    ("strange", "other"),
])
def test_category_of_errors(rows, error, kind):
    df = rows("_errors ARRAY<STRING>", ([error],))
    assert df.select(deadletter.error_category(F.col("_errors"))).first()[0] == kind


def test_each_row_in_its_own_folder(spark, letters, tmp_path):
    deadletter.write_dlq(letters, str(tmp_path))
    folders = {p.split(str(tmp_path))[1].rsplit("/", 1)[0] for p in glob.glob(f"{tmp_path}/*/*/*/part-*")}
    assert folders == {f"/pipeline_id=p/error_category={c}/date=2024-02-01" for c in ("schema_validation", "source_parsing_error")}
    assert deadletter.read_dlq(spark, str(tmp_path)).count() == 3


def test_files_roll_and_compress(letters, tmp_path):
    deadletter.write_dlq(letters, str(tmp_path), DeadLetters(max_records_per_file=1, compression="gzip"))
    files = glob.glob(f"{tmp_path}/*/*/*/part-*")
    assert len(files) == 3 and all(f.endswith(".json.gz") for f in files)


def test_a_repeated_batch_replaces_its_files(spark, letters, tmp_path):
    for batch in (0, 0, 1):
        deadletter.write_dlq(letters, str(tmp_path), batch_id=batch)
    assert deadletter.read_dlq(spark, str(tmp_path)).count() == 6


def test_replay_skips_what_was_replayed(spark, letters, tmp_path):
    ledger = str(tmp_path / "ledger")
    deadletter.mark_replayed(letters.where("error_category = 'source_parsing_error'"), ledger)

    def mend(df):
        return df.withColumn("original_data", F.replace("original_data", F.lit('"x"'), F.lit("5")))

    first = deadletter.replay(letters, spark.read.parquet(ledger), STRICT, mend)
    assert {(r.a, r.b) for r in first.collect()} == {(5, "y"), (None, "z")}
    deadletter.mark_replayed(first, ledger)
    assert deadletter.replay(letters, spark.read.parquet(ledger), STRICT, mend).count() == 0


def test_statistics(letters):
    found = {r.error_category: r for r in deadletter.dlq_stats(letters).collect()}
    assert {c: r.pending for c, r in found.items()} == {"schema_validation": 2, "source_parsing_error": 1}
    row = letters.where("error_category = 'source_parsing_error'").first().asDict()
    row["timestamp"] = "2024-02-01T12:00:00.000000Z"
    assert found["source_parsing_error"].bytes == len(json.dumps(row, separators=(",", ":")))
    assert found["source_parsing_error"].last_write == AT


def test_function_failures_become_letters(rows):
    made = apply_row_function(rows("v BIGINT", (2,), (0,)), lambda r: {"v": 10 // r["v"]}, fields(v=LONG))
    good, bad = deadletter.split(deadletter.failures_as_errors(made))
    letter = deadletter.to_dlq(bad, "p", AT, original=name("_input")).first()
    assert [r.v for r in good.collect()] == [5]
    assert (letter.error_category, letter.original_data) == ("transformation_error", '{"v": 0}')


def test_sink_failures_after_retries(rows, tmp_path):
    log = tmp_path / "written"
    log.mkdir()

    def write(row):
        if row["id"] == 2:
            raise OSError("down")
        (log / str(row["id"])).write_text("x")

    failed = deadletter.write_or_dlq(rows("id BIGINT", (1,), (2,), (3,)), write, "p", AT, retries=1)
    for _ in range(2):
        found = failed.collect()
        assert [(r.error_category, r.original_data, r.metadata["retry_count"]) for r in found] == [("sink_error", '{"id": 2}', "1")]
    assert sorted(p.name for p in log.iterdir()) == ["1", "3"]


def test_refused_lists_are_halved(spark, rows, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def write(part):
        (log / uuid.uuid4().hex).write_text(str(len(part)))
        if any(row["id"] in (5, 300) for row in part):
            raise OSError("down")

    table = spark.range(512).coalesce(1)
    failed = deadletter.write_batches_or_dlq(table, write, "p", AT, rows_a_call=128, retries=1)
    assert sorted(r.original_data for r in failed.collect()) == ['{"id": 300}', '{"id": 5}']
    sizes = [int(p.read_text()) for p in log.iterdir()]
    # Four lists; in two of them 7 halvings of two calls each, and one more try of a row alone.
    assert len(sizes) == 4 + 2 * (2 * 7 + 1) and sizes.count(128) == 4
    assert deadletter.write_batches_or_dlq(table.limit(0), write, "p", AT).count() == 0


def test_lists_that_never_fit_are_refused_at_once(rows):
    with pytest.raises(ValueError):
        deadletter.write_batches_or_dlq(rows("id BIGINT", (1,)), print, "p", AT, rows_a_call=0)
