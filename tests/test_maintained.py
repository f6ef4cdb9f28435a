"""Tables kept equal to the batch result while tickets arrive in pieces."""

import random

import pytest
from pyspark.sql import functions as F

from deskpulse import schemas
from deskpulse.plans import sla
from deskpulse.plans.durations import state_detail, visits
from deskpulse.streaming import incremental, maintained
from tests import fixtures as fx


def _rows(df):
    return sorted(map(repr, df.collect()))


def _run(spark, path, rows=None, schema=schemas.HISTORY, **options):
    if rows is not None:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path / "in"))
    new = incremental.new_records(spark, str(path / "in"), schema)
    return maintained.maintain_states(new, fx.holidays(spark), str(path / "c"), str(path / "out"), buckets=4, **options)


def _tables(spark, path):
    return [_rows(maintained.read_maintained(spark, str(path / "out"), n)) for n in ("detail", "verdicts")]


def _batch(spark, rows):
    history = spark.createDataFrame(rows, schemas.HISTORY)
    visited = visits(history, fx.holidays(spark))
    return [_rows(state_detail(history, fx.holidays(spark))), _rows(sla.verdict_table(sla.verdict_of(visited)))]


def _history(seed, tickets=12):
    r = random.Random(seed)
    rows, number = [], 0
    for t in range(tickets):
        for day in sorted(r.sample(range(1, 28), r.randint(2, 5))):
            number += 1
            state = r.choice(["En gestión", "En Validación", "Cerrado", "Crear ticket", None])
            key = None if t == 0 else f"T{t}"
            rows.append((key, state, f"{day:02d}/06/2020 08:00:00 +00:00", "20200630", number))
    return rows


@pytest.mark.parametrize("seed", [1])
def test_any_split_equals_the_batch(spark, tmp_path, seed):
    rows = _history(seed)
    r = random.Random(seed)
    r.shuffle(rows)
    cuts = sorted(r.sample(range(1, len(rows)), 2))
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        _run(spark, tmp_path, rows[a:b])
        assert _tables(spark, tmp_path) == _batch(spark, rows[:b])
    _run(spark, tmp_path)
    assert _tables(spark, tmp_path) == _batch(spark, rows)
    with pytest.raises(ValueError, match="buckets"):
        new = incremental.new_records(spark, str(tmp_path / "in"), schemas.HISTORY)
        maintained.maintain_states(new, fx.holidays(spark), str(tmp_path / "c"), str(tmp_path / "out"), buckets=5)


def test_only_the_buckets_of_new_tickets_are_replaced(spark, tmp_path):
    _run(spark, tmp_path, fx.HISTORY)
    first = maintained.manifest(spark, str(tmp_path / "out"))["verdicts"]["buckets"]
    _run(spark, tmp_path, [("T2", "Reabierto", "16/06/2020 12:00:00 +00:00", "20200630", 8)])
    second = maintained.manifest(spark, str(tmp_path / "out"))["verdicts"]["buckets"]
    assert {v for v in first.values()} == {0} and sorted(second.values()) == sorted([0] * (len(first) - 1) + [1])


def test_readers_see_a_failed_run_not_at_all(spark, tmp_path, monkeypatch):
    _run(spark, tmp_path, fx.HISTORY[:5])
    before = _tables(spark, tmp_path)
    reading = maintained.read_maintained(spark, str(tmp_path / "out"), "detail")
    real, calls = maintained.write_note, []

    def failing(spark, path, text):
        if "_manifests" in path and not calls:
            calls.append(path)
            raise RuntimeError("stopped before the manifest")
        real(spark, path, text)

    monkeypatch.setattr(maintained, "write_note", failing)
    with pytest.raises(Exception, match="stopped before the manifest"):
        _run(spark, tmp_path, fx.HISTORY[5:])
    assert _tables(spark, tmp_path) == before
    _run(spark, tmp_path)
    assert _tables(spark, tmp_path) == _batch(spark, fx.HISTORY)
    # a reader that started before the run still finds its files
    assert _rows(reading) == before[0]


def test_old_versions_go(spark, tmp_path):
    for row in range(4):
        _run(spark, tmp_path, fx.HISTORY[:3] if row == 0 else [("T1", "Cerrado", f"2{row}/06/2020 09:00:00 +00:00", "20200630", 10 + row)])
    versions = sorted(p.name for p in (tmp_path / "out" / "verdicts").iterdir() if p.name.startswith("version"))
    assert versions == ["version=2", "version=3"]
    assert len([p for p in (tmp_path / "out" / "_manifests").iterdir() if p.name.isdigit()]) == 2


def test_only_ticket_scope(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(ValueError, match="scope"):
        _run(spark, tmp_path, scope="file")


def test_nothing_yet(spark, tmp_path):
    assert maintained.read_maintained(spark, str(tmp_path / "out"), "detail") is None
    _run(spark, tmp_path, [])
    assert maintained.read_maintained(spark, str(tmp_path / "out"), "detail") is None
