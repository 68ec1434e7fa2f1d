"""Own streaming sources and pulled tables as sources of jobs."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException

from rowferry.errors import ConfigError
from rowferry.sources import plugin
from rowferry.streaming import pull, run
from rowferry.streaming.run import finish, run_history, run_metrics, run_pipeline
from test_stream import AT, Place, crash_once

# Workers cannot import this module, so its classes travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def place(tmp_path):
    return Place(tmp_path)


class Numbers(plugin.StreamedSource):
    """Counts up to the number in a file; notes what is acknowledged in another."""

    @classmethod
    def name(cls):
        return "test_numbers"

    def schema(self):
        return "id BIGINT, v STRING"

    def start(self):
        return {"n": 0}

    def latest(self):
        with open(self.options["path"]) as file:
            return {"n": int(file.read())}

    def parts_between(self, start, end):
        return range(start["n"], end["n"])

    def poll(self, part):
        yield part, str(part)

    def acknowledge(self, end):
        with open(self.options["path"] + ".done", "a") as file:
            file.write(json.dumps(end) + "\n")


class Fixed(plugin.PolledSource):
    @classmethod
    def name(cls):
        return "test_fixed"

    def schema(self):
        return "id BIGINT, v STRING"

    def parts(self):
        return [1, 2]

    def poll(self, part):
        yield part, "x"


def source_job(place, source, **options):
    return place.job(source={"type": "custom", "properties": {"format": source, "options": options}}, schema=None)


def test_a_streaming_source_resumes_and_is_acknowledged(spark, place):
    numbers = place.root / "n"
    job = source_job(place, plugin.register_source(spark, Numbers), path=str(numbers))
    for most in (3, 5, 5):
        numbers.write_text(str(most))
        place.run(spark, job)
    assert place.out(spark) == [(i, str(i)) for i in range(5)]
    said = [json.loads(line)["n"] for line in (place.root / "n.done").read_text().splitlines()]
    assert 3 in said and said == sorted(said)
    assert spark.read.format("test_numbers").option("path", str(numbers)).load().count() == 5


def test_a_failed_batch_of_a_streaming_source_is_read_again(spark, place, monkeypatch):
    numbers = place.root / "n"
    job = source_job(place, plugin.register_source(spark, Numbers), path=str(numbers))
    numbers.write_text("2")
    crash_once(monkeypatch, run, "archive")
    with pytest.raises(StreamingQueryException):
        place.run(spark, job)
    numbers.write_text("4")
    place.run(spark, job)
    assert place.out(spark) == [(0, "0"), (1, "1")]
    place.run(spark, job)
    assert place.out(spark) == [(i, str(i)) for i in range(4)]


def test_a_batch_source_is_read_once_by_a_job(spark, place):
    job = source_job(place, plugin.register_source(spark, Fixed))
    place.run(spark, job)
    place.run(spark, job)
    assert place.out(spark) == [(1, "x"), (2, "x")]


def pull_job(place, column="id", ddl="id BIGINT, v STRING", **more):
    properties = {"path": place.path("in"), "schema": ddl, "cursor_column": column, **more}
    return place.job(source={"type": "pull", "properties": properties}, schema=None)


def arrive(rows, place, ddl, *data):
    rows(ddl, *data).write.mode("append").parquet(place.path("in"))


def test_a_pull_takes_what_is_newer(spark, rows, place):
    ddl, job = "id BIGINT, v STRING", pull_job(place)
    arrive(rows, place, ddl, (1, "a"), (2, "b"), (None, "never"))
    for step in range(3):
        place.run(spark, job)
        if step == 0:
            arrive(rows, place, ddl, (3, "c"), (2, "late"))
    assert place.out(spark) == [(1, "a"), (2, "b"), (3, "c")]
    assert [r.status for r in run_history(spark, place.path("state")).orderBy("seq").collect()] == ["starting", "running", "stopped"] * 3
    assert run_metrics(spark, place.path("state")).count() == 2


def test_pages_keep_ties_together(spark, rows, place):
    ddl = "id BIGINT, at TIMESTAMP"
    arrive(rows, place, ddl, *[(i, AT.replace(second=i // 3, microsecond=7)) for i in range(10)])
    job = pull_job(place, "at", ddl, page_rows=4)
    place.run(spark, job)
    counts = [r.records_consumed for r in run_metrics(spark, place.path("state")).orderBy("batch_id").collect()]
    assert counts == [6, 4] and len(place.out(spark, "id BIGINT")) == 10


def test_a_crashed_pull_repeats_its_range(spark, rows, place, monkeypatch):
    ddl, job = "id BIGINT, v STRING", pull_job(place)
    arrive(rows, place, ddl, (1, "a"))
    crash_once(monkeypatch, run, "archive")
    with pytest.raises(OSError):
        place.run(spark, job)
    arrive(rows, place, ddl, (2, "b"))
    place.run(spark, job)
    assert place.out(spark) == [(1, "a"), (2, "b")]
    assert run_metrics(spark, place.path("state")).where("records_consumed = 1").count() == 2
    assert run_history(spark, place.path("state")).where("status LIKE 'failed: lost%'").count() == 1


def test_the_range_reaches_the_scan(spark, rows, place):
    from plans import plan

    arrive(rows, place, "id BIGINT, v STRING", (1, "a"))
    table = spark.read.parquet(place.path("in"))
    wanted = pull.Range(1, "1", "5", AT).rows(table, "id")
    assert "PushedFilters: [IsNotNull(id), LessThanOrEqual(id,5), GreaterThan(id,1)]" in plan(wanted)


def test_a_pull_ends(spark, place):
    with pytest.raises(ConfigError, match="run it again"):
        run_pipeline(spark, pull_job(place), place.path("state"), once=False)
    finish(spark, None, pull_job(place), place.path("state"))
