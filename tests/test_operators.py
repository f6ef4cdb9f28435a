"""Operators against brute force, with hot keys and under reshuffling."""

import random

import pytest
from pyspark.sql import functions as F

from deskpulse.operators import columns, combine, counts, dedupe, next_row
from deskpulse.plans import durations, sla
from deskpulse.sources import tables as io
from tests import fixtures as fx
from workload import tables as given


def _skewed_rows(seed):
    """One group holds most rows, many of them in one hour and one second."""
    rng = random.Random(seed)
    rows = []
    for i in range(3000):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c", None])
        if group == "hot" and rng.random() < 0.5:
            second = 7200 + (5 if rng.random() < 0.5 else rng.randrange(3600))
        else:
            second = rng.randrange(86400 * 20)
        rows.append((group, "w" if rng.random() < 0.5 else "v", second, i * 3, f"s{i % 7}"))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def skewed(spark):
    rows = _skewed_rows(5)
    df = spark.createDataFrame(rows, "g string, p string, second bigint, seq bigint, state string")
    return rows, df.withColumn("ts", F.timestamp_seconds("second"))


def _follow(rows, key, order):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    following = {}
    for members in groups.values():
        members.sort(key=order)
        for row, after in zip(members, [*members[1:], None]):
            following[row[3]] = after and (after[4], after[3])
    return following


def _found(df):
    rows = df.select("seq", "has_next", "next_state", "next_seq").collect()
    return {r.seq: (r.next_state, r.next_seq) if r.has_next else None for r in rows}


@pytest.mark.parametrize("split_rows", [1, 7, 100, 1_000_000, None])
def test_next_in_group_equals_brute_force(skewed, split_rows):
    rows, df = skewed
    got = next_row.next_in_group(df, ["g", "p"], "ts", "seq", ["state", "seq"], split_rows)
    found = _found(got)
    assert found == _follow(rows, lambda r: r[:2], lambda r: (r[2], r[3]))


def test_hot_group_is_cut_into_bounded_slices(skewed):
    _, df = skewed
    got = next_row.next_in_group(df, ["g", "p"], "ts", "seq", ["state"], 100)
    largest = got.groupBy("_group", "_slice").count().agg(F.max("count")).head()[0]
    assert largest <= 100
    whole = df.groupBy("g", "p").count().agg(F.max("count")).head()[0]
    assert whole > 500


@pytest.mark.parametrize("chunk_rows", [1, 10, 1000, 1_000_000])
def test_next_in_sequence_equals_brute_force(skewed, chunk_rows):
    rows, df = skewed
    got = next_row.next_in_sequence(df, "seq", ["state", "seq"], chunk_rows)
    found = _found(got)
    assert found == _follow(rows, lambda r: 0, lambda r: r[3])


def test_sparse_numbers_give_few_slices(spark):
    """100,000 rows with numbers ten million apart, and a dense run far away from them."""
    split = 1000
    numbers = F.when(F.col("id") < 100_000, F.col("id") * 10_000_000).otherwise(10**15 + F.col("id"))
    df = spark.range(110_000).select(numbers.alias("seq"), F.col("id").alias("n"))
    sliced = next_row.sequence_slices(df, "seq", split)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) <= 3 * 110 and max(sizes) <= 3 * split
    led = next_row.next_in_sequence(df, "seq", ["n"], split)
    assert led.where("has_next").where("next_n <> n + 1").count() == 0
    assert [r.n for r in led.where("NOT has_next").collect()] == [109_999]


def test_sparse_numbers_in_one_hour_of_a_hot_group(spark):
    split = 1000
    rows = spark.range(20_000).select(
        F.lit("g").alias("g"),
        F.lit("p").alias("p"),
        F.timestamp_seconds(F.when(F.col("id") < 12_000, F.col("id") * 3600 / 12_000).otherwise(3599).cast("bigint")).alias("ts"),
        (F.col("id") * 10_000_000).alias("seq"),
        F.col("id").alias("n"),
    )
    led = next_row.next_in_group(rows, ["g", "p"], "ts", "seq", ["n"], split)
    sizes = [r["count"] for r in led.groupBy("_group", "_slice").count().collect()]
    assert len(sizes) <= 3 * 20 + 200 and max(sizes) <= 2 * split
    assert led.where("has_next").where("next_n <> n + 1").count() == 0
    assert [r.n for r in led.where("NOT has_next").collect()] == [19_999]


def test_both_scopes_agree_on_contiguous_tickets(spark):
    rows = []
    for ticket in range(40):
        rows.append((f"T{ticket}", "Crear ticket", 0))
        rows += [(f"T{ticket}", "En gestión", k + 1) for k in range(ticket % 5)]
    rows = [
        (i, s, f"{1 + k:02d}/06/2020 08:00:00 +00:00", "20200630", n) for n, (i, s, k) in enumerate(rows)
    ]
    history = fx.history(spark, rows)

    def led(scope, split):
        df = durations.with_next_state(history, scope, split_rows=split)
        return sorted(tuple(r) for r in df.select("row_seq", "next_state", "next_time").collect())

    assert led("ticket", 3) == led("file", 4) == led("ticket", 10**6)


def test_copies_of_a_ticket_do_not_interleave(spark):
    again = [(i, s, f, "20200731", q + 100) for i, s, f, _, q in fx.HISTORY]
    history = fx.history(spark, fx.HISTORY + again)
    verdicts = sla.ticket_verdict(history, fx.holidays(spark))
    assert {r.id_ticket: r.seconds for r in verdicts.collect()} == {"T1": 518400.0, "T2": 1209600.0}


def test_end_before_start_and_missing_state(spark):
    rows = [
        ("T1", "Crear ticket", "01/06/2020 08:00:00 +00:00", "p", 1),
        ("T1", None, "10/06/2020 08:00:00 +00:00", "p", 2),
        ("T1", "Cerrado", "01/06/2020 05:00:00 +00:00", "p", 3),
    ]
    detail = durations.state_detail(fx.history(spark, rows), fx.holidays(spark), scope="file").collect()
    assert len(detail) == 1
    row = detail[0]
    assert (row.estado, row.dias_festivos, row.diferencia_tiempo_dias, row.diferencia_tiempo_festivos) == (
        None, "0.0", "-9.12", "0.00",
    )
    assert f"{-9.125:.2f}" == "-9.12"


def test_null_keys_get_no_verdict(spark):
    rows = [
        (None, "En gestión", "01/06/2020 08:00:00 +00:00", "p", 1),
        ("T1", "En gestión", "01/06/2020 08:00:00 +00:00", None, 2),
        ("T2", "Cerrado", "01/06/2020 08:00:00 +00:00", "p", 3),
    ]
    assert sla.ticket_verdict(fx.history(spark, rows), fx.holidays(spark)).count() == 0


def test_saturday_holiday_counts_once(spark):
    rows = [
        ("T1", "En gestión", "05/06/2020 08:00:00 +00:00", "p", 1),
        ("T1", "Cerrado", "08/06/2020 08:00:00 +00:00", "p", 2),
    ]
    holidays = fx.holidays(spark, [("06/06/2019",), ("06/06/2018",)])
    assert sla.ticket_verdict(fx.history(spark, rows), holidays).head().off_days == 2.0


def test_no_holidays_and_no_history(spark):
    none = fx.holidays(spark, [])
    assert sla.ticket_verdict(fx.history(spark), none).filter("off_days = 4").count() == 1
    assert sla.ticket_verdict(fx.history(spark, []), none).count() == 0


def test_event_verdicts_have_the_known_counts(spark):
    days = fx.holidays(spark, [("01/01/2019",), ("15/01/2019",)])
    verdicts = sla.ticket_verdict(
        given.history(spark, "/root/testdata/sf0.001"), days, sla_days=1.0, years=(2024,)
    )
    assert verdicts.count() == 15
    assert verdicts.filter("ok_ko = 'KO'").count() == 2


# --- de-duplication --------------------------------------------------------------


def test_first_per_key_does_not_depend_on_row_order(spark):
    rng = random.Random(9)
    rows = [
        ("hot" if rng.random() < 0.4 else str(rng.randrange(20)), rng.choice([None, "x", "y"]), rng.randrange(5))
        for _ in range(800)
    ]
    want = {}
    for key, a, b in rows:
        rank = (a is not None, a or "", b)
        if key not in want or rank < want[key][0]:
            want[key] = (rank, (key, a, b))
    for parts in (1, 3, 8):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, a string, b int").repartition(parts)
        got = {r.k: tuple(r) for r in dedupe.first_per_key(df, ["k"]).collect()}
        assert got == {k: row for k, (_, row) in want.items()}


def test_preferred_source_wins(spark):
    left = spark.createDataFrame([("a", 2), ("a", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", 9)], "k string, v int")
    got = sorted(tuple(r) for r in dedupe.preferred_per_key([left, right], ["k"]).collect())
    assert got == [("a", 2), ("b", 9)]


def test_regrouping_verdicts_changes_nothing(spark):
    verdicts = sla.ticket_verdict(fx.history(spark), fx.holidays(spark))
    again = sla.regrouped(verdicts)
    same = verdicts.select("id_ticket", "end_day", "seconds", "off_days")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, same.collect()))


# --- columns, unions, counts, tables -------------------------------------------------


def test_column_operators(spark):
    df = spark.createDataFrame([("x", None, float("nan"))], "a string, b string, c double")
    assert columns.rename_all(df, ["p", "q", "r"]).columns == ["p", "q", "r"]
    assert columns.insert_column(df, 1, "n", F.lit(1)).columns == ["a", "n", "b", "c"]
    assert columns.insert_column(df, 14, "n", F.lit(1)).columns == ["a", "b", "c", "n"]
    assert columns.move_last(df, "a").columns == ["b", "c", "a"]
    assert columns.in_order(df, ["c", "a"]).columns == ["c", "a"]
    assert columns.as_text(df.select("c"), "c").head().c == "NaN"
    assert tuple(columns.fill_missing(df).head()) == ("x", "0.0", 0.0)
    swapped = columns.replace_cells(df, {"x": "y"}, {"y": "z"})
    assert swapped.head().a == "z"
    pairs = spark.createDataFrame([("x", "y"), (None, "q"), ("u", None)], "old string, new string")
    cells = spark.createDataFrame([("x", "u", 1), ("v", None, 2)], "a string, b string, c int")
    assert [tuple(r) for r in columns.replace_cells(cells, pairs).collect()] == [("y", None, 1), ("v", None, 2)]
    assert columns.replace_cells(cells, pairs.limit(0)).collect() == cells.collect()
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        columns.replace_cells(cells, pairs.union(pairs)).collect()


def test_unions_and_members(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1)], "k string, v int")
    b = spark.createDataFrame([("y", 2), (None, 3)], "otro string, w int")
    assert combine.union_distinct([a, a]).count() == 1
    both = combine.union_all([a, b.toDF("k", "v")])
    assert combine.members(both, spark.createDataFrame([("y",), (None,)], "k string"), "k").count() == 1
    assert combine.members(both, spark.createDataFrame([], "k string"), "k").count() == 0
    yes, no = combine.split_by(both, F.col("k") == "x")
    assert (yes.count(), no.count()) == (2, 1)


def test_counts(spark):
    a = spark.range(3)
    assert [tuple(r) for r in counts.row_counts({"a": a}).collect()] == [("a", 3)]
    assert counts.empty_tables({"a": a, "b": a.limit(0)}) == ["b"]
    watched, seen = counts.counted(a, "n")
    watched.collect()
    assert seen.get["records"] == 3


def test_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    io.write_table(df, path, partition_by=["k"])
    io.write_table(df, path, partition_by=["k"], single_file=True)
    assert io.read_table(spark, path).count() == 4
    df.createOrReplaceTempView("una_tabla")
    assert io.read_tables(spark, ["una_tabla"])["una_tabla"].count() == 2
    staged, path = io.stage(df, "t")
    assert staged.count() == 2 and io.exists(spark, path)
    io.unstage(spark, path)
    assert not io.exists(spark, path)


def test_history_takes_its_order_from_the_files(spark, tmp_path):
    path = str(tmp_path / "h")
    first = spark.createDataFrame([(f"a{i}",) for i in range(5)], "id_ticket string")
    second = spark.createDataFrame([(f"b{i}",) for i in range(5)], "id_ticket string")
    first.coalesce(1).write.parquet(path + "/x=1 a")
    second.coalesce(1).write.parquet(path + "/x=2 ñ")
    rows = io.read_history(spark, path).orderBy("row_seq").collect()
    assert len({r.row_seq for r in rows}) == 10
    names = [r.id_ticket for r in rows]
    for letter in "ab":
        assert [n for n in names if n[0] == letter] == [f"{letter}{i}" for i in range(5)]


def _plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_large_file_is_not_shuffled_to_one_task(spark, tmp_path):
    """The ranks of the files travel to the rows, however large a table is said to be."""
    path = str(tmp_path / "h")
    spark.range(1000).selectExpr("cast(id as string) AS id_ticket").coalesce(1).write.parquet(path)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = io.read_history(spark, path)
        assert "SortMergeJoin" not in _plan_of(rows)
        assert [r.row_seq for r in rows.orderBy("row_seq").collect()] == list(range(1000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_only_the_earliest_rows_of_slices_are_sorted_for_their_heads(spark):
    """An order that is null, or the same in a whole slice, has its heads too."""
    rows = spark.range(3000).selectExpr("CASE WHEN id >= 5 THEN id END AS seq", "concat('s', id) AS state")
    led = next_row.next_in_sequence(rows, "seq", ["state"], 100)
    plan = _plan_of(led)
    assert "_earliest" in plan[plan.rindex("SortAggregate"):]
    found = {r.state: r.next_state for r in led.collect()}
    assert all(found[f"s{i}"] == f"s{i + 1}" for i in range(5, 2999)) and found["s2999"] is None
    assert [found[f"s{i}"] for i in range(5)].count("s5") == 1
