"""Incremental runs over growing folders."""

import pytest
from pyspark.sql import functions as F

from deskpulse import schemas
from deskpulse.streaming import incremental
from tests import fixtures as fx
from workload import queries


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_each_run_takes_only_new_files(spark, tmp_path):
    source, checkpoint, out = (str(tmp_path / n) for n in ("in", "checkpoint", "out"))
    holidays = fx.holidays(spark)

    def run():
        new = incremental.new_records(spark, source, schemas.HISTORY)
        incremental.append_state_detail(new, holidays, checkpoint, out)
        return incremental.read_appended(spark, out)

    fx.history(spark, fx.HISTORY[:4]).write.parquet(source)
    first = _rows(run())
    assert len(first) == 2
    fx.history(spark, fx.HISTORY[4:]).write.mode("append").parquet(source)
    second = _rows(run())
    assert len(second) == 3 and set(first) < set(second)
    assert _rows(run()) == second


def _run(spark, path, *names, **options):
    new = incremental.new_records(spark, str(path / names[0]), "k string, v int")
    return incremental.append_new(
        new, str(path / names[1]), lambda df: df, str(path / "out"), **options
    )


def _land(spark, place, rows):
    spark.createDataFrame(rows, "k string, v int").coalesce(1).write.mode("append").parquet(str(place))


def _out(spark, path):
    return sorted(tuple(r) for r in incremental.read_appended(spark, str(path / "out")).collect())


def test_lost_checkpoint_after_two_batches(spark, tmp_path):
    for row in (("a", 1), ("b", 2)):
        _land(spark, tmp_path / "in", [row])
        _run(spark, tmp_path, "in", "checkpoint")
    assert _out(spark, tmp_path) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="checkpoint was lost"):
        _run(spark, tmp_path, "in", "fresh")
    assert _out(spark, tmp_path) == [("a", 1), ("b", 2)]
    for _ in range(2):
        _run(spark, tmp_path, "in", "fresh", replace=True)
        assert _out(spark, tmp_path) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError, match="another stream"):
        _run(spark, tmp_path, "in", "checkpoint")


def test_two_streams_into_one_table(spark, tmp_path):
    _land(spark, tmp_path / "one", [("a", 1), ("b", 2)])
    _land(spark, tmp_path / "two", [("c", 3), ("d", 4), ("e", 5)])
    _run(spark, tmp_path, "one", "c1", stream="one")
    with pytest.raises(ValueError, match="another stream"):
        _run(spark, tmp_path, "two", "c2", stream="one")
    _run(spark, tmp_path, "two", "c2", stream="two")
    _land(spark, tmp_path / "one", [("f", 6)])
    _run(spark, tmp_path, "one", "c1", stream="one")
    assert [k for k, _ in _out(spark, tmp_path)] == list("abcdef")


def test_new_records_meet_the_whole_static_table(spark, tmp_path):
    source, checkpoint, out = (str(tmp_path / n) for n in ("in", "checkpoint", "out"))
    static = spark.createDataFrame([("T1", "uno"), ("T2", "dos")], "id_ticket string, name string")
    for part in (fx.HISTORY[:4], fx.HISTORY[4:]):
        fx.history(spark, part).write.mode("append").parquet(source)
        new = incremental.new_records(spark, source, schemas.HISTORY)
        incremental.join_new(new, static, ["id_ticket"], checkpoint, out)
    joined = incremental.read_appended(spark, out)
    assert joined.groupBy("name").count().count() == 2
    assert joined.count() == 7


def test_both_sides_must_be_new(spark, tmp_path):
    left, right, folder = (str(tmp_path / n) for n in ("l", "r", "parked"))
    schema = "k string, v int"
    seen = []

    def run():
        return incremental.run_both_new(
            spark,
            incremental.new_records(spark, left, schema),
            incremental.new_records(spark, right, schema),
            str(tmp_path / "checkpoint"),
            folder,
            lambda a, b: seen.append((a.count(), b.count())),
        )

    spark.createDataFrame([("a", 1)], schema).write.parquet(left)
    spark.createDataFrame([], schema).write.parquet(right)
    assert run() is False
    spark.createDataFrame([("b", 2)], schema).write.mode("append").parquet(right)
    assert run() is False
    spark.createDataFrame([("c", 1)], schema).write.mode("append").parquet(left)
    spark.createDataFrame([("d", 2), ("e", 2)], schema).write.mode("append").parquet(right)
    assert run() is True
    assert seen == [(1, 2)]


def _both(spark, path, job, **options):
    return incremental.run_both_new(
        spark,
        incremental.new_records(spark, str(path / "l"), "k string, v int"),
        incremental.new_records(spark, str(path / "r"), "k string, v int"),
        str(path / "checkpoint"),
        str(path / "parked"),
        job,
        **options,
    )


def test_job_that_fails_once_loses_nothing(spark, tmp_path):
    seen = []

    def fail(left, right):
        raise RuntimeError("no space left")

    def count(left, right):
        seen.append((left.count(), right.count()))

    _land(spark, tmp_path / "l", [("a", 1)])
    _land(spark, tmp_path / "r", [("b", 2), ("c", 3)])
    for _ in range(2):
        with pytest.raises(RuntimeError, match="no space left"):
            _both(spark, tmp_path, fail)
    # what lands meanwhile is another run: its rows do not meet those of the failed one
    _land(spark, tmp_path / "l", [("d", 4), ("e", 5)])
    _land(spark, tmp_path / "r", [("f", 6)])
    assert _both(spark, tmp_path, count) is True
    assert seen == [(1, 2), (2, 1)]
    assert _both(spark, tmp_path, count) is False
    assert len(seen) == 2


def test_table_of_runs_replaces_a_repeated_run(spark, tmp_path):
    fails = [True]

    def run():
        sources = {
            n: incremental.new_records(spark, str(tmp_path / n), "k string, v int") for n in ("l", "r")
        }

        def both(new):
            if fails.pop() if fails else False:
                raise RuntimeError("stopped")
            return new["l"].unionByName(new["r"])

        incremental.append_together(
            spark, sources, str(tmp_path / "c"), str(tmp_path / "parked"), both, str(tmp_path / "out")
        )

    _land(spark, tmp_path / "l", [("a", 1)])
    _land(spark, tmp_path / "r", [("b", 2)])
    with pytest.raises(RuntimeError):
        run()
    run()
    _land(spark, tmp_path / "l", [("c", 3)])
    _land(spark, tmp_path / "r", [("d", 4)])
    run()
    rows = incremental.read_runs(spark, str(tmp_path / "out")).collect()
    assert sorted(r.k for r in rows) == ["a", "b", "c", "d"]


def test_lost_checkpoint_of_a_parked_source(spark, tmp_path):
    _land(spark, tmp_path / "l", [("a", 1)])
    _land(spark, tmp_path / "r", [("b", 2)])
    seen = []
    call = lambda left, right: seen.append((left.count(), right.count()))
    assert _both(spark, tmp_path, call)
    (tmp_path / "checkpoint").rename(tmp_path / "lost")
    with pytest.raises(ValueError, match="checkpoint was lost"):
        _both(spark, tmp_path, call)
    assert seen == [(1, 1)]
    assert _both(spark, tmp_path, call, replace=True)
    assert seen == [(1, 1), (1, 1)]


def test_any_new_source_is_enough_on_request(spark, tmp_path):
    _land(spark, tmp_path / "l", [("a", 1)])
    _land(spark, tmp_path / "r", [])
    sources = {n: incremental.new_records(spark, str(tmp_path / n), "k string, v int") for n in ("l", "r")}
    seen = []
    called = incremental.run_new_together(
        spark, sources, str(tmp_path / "c"), str(tmp_path / "parked"), lambda new, run: seen.append(sorted(new)), "any"
    )
    assert called == 1 and seen == [["l"]]


def test_rows_that_land_in_two_runs_are_computed_once(spark):
    computed = spark.sparkContext.accumulator(0)

    def seen(n):
        computed.add(1)
        return (n,)

    rows = spark.createDataFrame(spark.sparkContext.range(90, numSlices=3).map(seen), "n long")
    part = F.when(F.col("n") < 80, F.col("n") % 2)  # the last ten belong to neither run
    landed = []

    def run(streams, folder):
        landed.append(sorted(r.n for r in spark.read.parquet(f"{folder}/in/numbers").collect()))

    queries._in_two_runs(spark, "computed-once", {"numbers": (rows, part)}, run)
    assert landed == [list(range(0, 80, 2)), list(range(80))]
    assert computed.value == 90
