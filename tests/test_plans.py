"""Jobs on edge cases and against brute force; shapes of the physical plans."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from deskpulse import schemas
from deskpulse.operators.dedupe import first_per_key
from deskpulse.plans import categories as cats
from deskpulse.plans import durations, indicators, jobs, landing, publish, sla, tickets
from tests import fixtures as fx
from workload import queries
from workload import tables as given

# --- ticket list ---------------------------------------------------------------------

VERDICTS = "id_ticket string, date string, Diferencia_tiempo double, dias_festivos string, diferencia_tiempo_festivos string, Diferencia_tiempo_dias string, ok_ko string"


def test_ticket_without_closing_date_keeps_its_row(spark):
    verdicts = spark.createDataFrame([("T1", "0", 0.0, "0.0", "0.0", "0.0", "OK")], VERDICTS)
    listed = tickets.ticket_list(fx.description(spark), verdicts)
    assert [r.date for r in listed.collect()] == [None]
    assert tickets.tickets_without_month(listed).head()[0] == 1


def test_list_equals_join_then_dedupe(spark):
    """De-duplicating both sides first gives the rows of the join de-duplicated after it."""
    rng = random.Random(4)
    described = [
        (f"T{rng.randrange(6)}", rng.choice("PQ"), rng.choice(["F", None]), rng.choice("AB"),
         float(rng.randrange(-1, 3)), float(rng.randrange(-1, 3)), rng.choice([None, "u"]), "x")
        for _ in range(120)
    ]
    judged = [
        (f"T{rng.randrange(7)}", rng.choice(["20200615", "20200616", "20200701", "0"]), float(rng.randrange(3)),
         "0.0", "1.5", "1.5", rng.choice(["OK", "KO"]))
        for _ in range(40)
    ]
    description = spark.createDataFrame(described, fx.schemas.DESCRIPTION)
    verdicts = spark.createDataFrame(judged, VERDICTS)
    joined = tickets.repaired_description(description).join(tickets.dated_verdicts(verdicts), "id_ticket")
    want = first_per_key(joined, ["id_ticket", "proyecto", "flujo", "date"])
    got = tickets.ticket_list(description, verdicts)
    assert got.count() > 10
    columns = want.columns
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.collect()))


# --- indicators ------------------------------------------------------------------------

TICKETS = "id_ticket string, proyecto string, flujo string, tipo_solicitud string, volumen_total_casos double, diferencia_tiempo_festivos string, sum_casos_ok string, date string"


def _random_tickets(seed):
    rng = random.Random(seed)
    return [
        (str(i), rng.choice(["P", "Q"]), rng.choice(["F1", "F2", "F3", None]),
         rng.choice(["A", "B", "Todas", None]), float(rng.randrange(1, 5)), str(rng.randrange(8) / 4),
         str(float(rng.randrange(3))), rng.choice(["01/06/2020", "01/07/2020"]))
        for i in range(600)
    ]


CATEGORY_ROWS = [
    ("I1", "Q", "F1", "Todas", "P_F1_Todas"),
    ("I1", "Q", "F1", "Todas", "P_F1_Todas"),
    ("I2", "Q", "F2", "A", "P_F2_A"),
    ("I3", "Q", "F1", "B", "Q_F1_B"),
    ("I4", "ANS", "F3", "Todas", "P_F2_Todas"),
    ("I5", "ANS", "F2", "Todas", "P_F2_Todas"),
    ("I6", "KPI", "F1", "A", "P_F1_A"),
    ("I7", "KPI", None, "A", "P_F1_A"),
    ("I8", "KPI", "F3", None, "Q_F3_A"),
    ("I9", "X", "F1", "Todas", "P_F1_Todas"),
]


def _brute_force(rows, categories):
    """Six grouped queries with their flow lists, joined to the categories one by one."""
    out = {}
    for kind in ("Q", "ANS", "KPI"):
        own = [c for c in categories if c[1] == kind]
        flows = (
            {c[2] for c in own if c[3] == "Todas"} - {None},
            {c[2] for c in own if c[3] not in ("Todas", None)} - {None},
        )
        for branch in (0, 1):
            sums = {}
            for _, project, flow, request, volume, time, ok, month in rows:
                if flow in flows[branch]:
                    key = (project, flow, "Todas" if branch == 0 else request, month)
                    total = sums.setdefault(key, [0.0, 0.0, 0.0])
                    for i, v in enumerate((volume, float(time), float(ok))):
                        total[i] += v
            for (project, flow, request, month), total in sums.items():
                if None in (project, flow, request):
                    continue
                text = f"{project}_{flow}_{request}".lower()
                for c in own:
                    if c[4].lower() == text:
                        fed = out.setdefault((c[0], kind, month), [0.0, 0.0, 0.0])
                        for i in range(3):
                            fed[i] += total[i]
    pick = {"Q": lambda t: t[0], "ANS": lambda t: t[1] / t[0], "KPI": lambda t: t[2] / t[0]}
    return {(i, month): pick[kind](t) for (i, kind, month), t in out.items()}


def test_indicators_equal_six_queries(spark):
    rows = _random_tickets(1)
    got = indicators.indicators(
        spark.createDataFrame(rows, TICKETS), fx.categories(spark, CATEGORY_ROWS)
    ).collect()
    want = _brute_force(rows, CATEGORY_ROWS)
    assert len(got) == len(want) >= 8
    assert {(r.id, r.fecha): r.valor for r in got} == want
    assert {r.tipo_reg for r in got} == {0}


@pytest.mark.parametrize("size", [0, 1, 2])
def test_flow_lists_of_any_size(spark, size):
    listed = [("I%d" % i, "Q", f"F{i + 1}", "Todas", f"P_F{i + 1}_Todas") for i in range(size)]
    rows = _random_tickets(2)
    raw = fx.categories(spark, listed) if listed else fx.categories(spark, CATEGORY_ROWS).limit(0)
    got = indicators.indicators(spark.createDataFrame(rows, TICKETS), raw)
    assert {(r.id, r.fecha): r.valor for r in got.collect()} == _brute_force(rows, listed)
    tickets = spark.createDataFrame(rows, TICKETS)
    by_sql = indicators.rollup_by_sql(tickets, 1, [c[2] for c in listed])
    flows = {r.flujo for r in by_sql.collect()}
    assert flows == {c[2] for c in listed}


def test_unreadable_numbers_are_skipped_or_zero(spark):
    rows = [("1", "P", "F1", "A", 2.0, "x", "1.0", "m"), ("2", "P", "F1", "A", None, "1.5", None, "m")]
    df = spark.createDataFrame(rows, TICKETS)
    for zero_fill in (False, True):
        row = indicators.request_sums(df, zero_fill).head()
        assert (row.volumen_total_casos, row.total_tiempo, row.sum_casos_ok) == (2.0, 1.5, 1.0)
    empty = spark.createDataFrame([("3", "P", "F1", "A", 0.0, "1", "1", "m")], TICKETS)
    ratios = [r.ratio_ok for r in indicators.rollups(empty).collect()]
    assert ratios == [None, None]


def test_repaired_spellings(spark):
    old = list(schemas.NAME_REPAIRS) + ["otro"]
    keys = list(schemas.KEY_REPAIRS) + ["Otra_Clave_X"]
    rows = [("I", "Q", n, n, k) for n, k in itertools.product(old, keys)]
    got = cats.repaired_categories(fx.categories(spark, rows))
    assert got.columns == schemas.CATEGORIES.fieldNames()
    flows = {r.flujo for r in got.select("flujo").distinct().collect()}
    assert flows == set(schemas.NAME_REPAIRS.values()) | {"otro"}
    found = {r.id_pro_flu_sol for r in got.select("id_pro_flu_sol").distinct().collect()}
    assert found == {k.lower() for k in schemas.KEY_REPAIRS.values()} | {"otra_clave_x"}


def test_totals_need_a_known_kind(spark):
    with pytest.raises(ValueError):
        indicators.indicator_totals(spark.createDataFrame([], TICKETS), None, "Q")


# --- landing and publishing ---------------------------------------------------------------


def test_narrow_table_is_left_out(spark):
    good = fx.standard(spark, [("A", "f", "p", "1"), ("A", "f", "p", "1")])
    other = good.toDF(*[f"c{i}" for i in range(13)])
    table, report = landing.standardise({"a": good, "narrow": good.drop("descripción"), "b": other})
    assert table.columns == list(schemas.STANDARD_COLUMNS)
    assert table.count() == 1
    assert {(r.table_name, r.columns, r.taken) for r in report.collect()} == {
        ("a", 13, True), ("narrow", 12, False), ("b", 13, True),
    }
    assert dict(table.dtypes)["calibración"] == "string"
    none, _ = landing.standardise({"narrow": good.drop("descripción")})
    assert none.count() == 0 and none.columns == table.columns


def test_publish_modes_need_a_known_name(spark):
    rows = fx.standard(spark, [("A", "f", "p", "1")])
    with pytest.raises(ValueError):
        publish.publish(rows, rows, "other")


def test_claim_wins_whatever_the_partitioning(spark):
    primary = fx.standard(spark, [(f"I{i % 7}", "f", "p", str(i)) for i in range(100)])
    claims = fx.standard(spark, [("I3", "f", "p", "9"), ("I3", "f", "p", "8"), ("N", "f", "p", "1")])
    for parts in (1, 5):
        got = publish.publish(primary.repartition(parts), claims.repartition(parts))
        values = {r.id: r.valor for r in got.collect()}
        assert len(values) == got.count() == 8
        assert (values["I3"], values["N"], values["I1"]) == ("8", "1", "1")


# --- jobs -------------------------------------------------------------------------------------


def test_jobs_from_history_to_output(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    history = fx.history(spark)
    report = jobs.run_states(history, fx.holidays(spark), at("detail"), at("verdicts"), single_file=True)
    assert list(report.written.values()) == [3, 2]
    read = spark.read.parquet
    report = jobs.run_tickets(fx.description(spark), read(at("verdicts")), at("tickets"))
    assert report.written == {at("tickets"): 2}
    jobs.run_indicators(read(at("tickets")), fx.categories(spark, fx.CATEGORIES), at("computed"))
    landed = fx.standard(spark, [("S1", "f", "p", "1")])
    report = jobs.run_landing(
        {"a": landed, "empty": landed.limit(0), "narrow": landed.drop("id")}, at("standard")
    )
    assert (report.empty, report.left_out) == (["empty"], [("narrow", 12)])
    assert report.messages()[0] == "Table empty doesn't have new records"
    jobs.run_primary(read(at("standard")), read(at("computed")), at("primary"))
    claims = fx.standard(spark, [("I2", "01/06/2020", "G", "1,9")])
    report = jobs.run_output(read(at("primary")), claims, at("output"))
    values = {r.id: r.valor for r in read(at("output")).collect()}
    assert values == {"S1": "1", "I1": "5,0", "I2": "1,9", "I3": "0,2", "I4": "4,0"}
    assert report.written == {at("output"): 5}


def test_jobs_write_nothing_without_input(spark, tmp_path):
    path = str(tmp_path / "nothing")
    landed = fx.standard(spark, [("S1", "f", "p", "1")])
    none = landed.limit(0)
    reports = [
        jobs.run_states(fx.history(spark, []), fx.holidays(spark), path, path),
        jobs.run_tickets(fx.description(spark), spark.createDataFrame([], VERDICTS), path),
        jobs.run_indicators(spark.createDataFrame([], TICKETS), None, path),
        jobs.run_landing({"a": none}, path),
        jobs.run_primary(landed, none, path),
        jobs.run_output(none, landed, path),
    ]
    assert [r.empty for r in reports] == [
        ["history"], ["verdicts"], ["tickets"], ["a"], ["indicators"], ["primary"],
    ]
    assert not any(r.written for r in reports)
    assert not (tmp_path / "nothing").exists()


# --- physical plans ------------------------------------------------------------------------------


def _plan(df, final=True):
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("\n+- == Initial Plan ==")[0]


def test_no_python_in_any_plan(spark, sf_dir):
    for name in ("state_detail", "ticket_sla", "verdict_table", "service_report"):
        plan = _plan(queries.QUERIES[name](spark, sf_dir), final=False)
        assert "EvalPython" not in plan and "InPandas" not in plan


def test_without_hot_groups_the_plan_is_one_window(spark, sf_dir):
    visited = durations.visits(
        given.history(spark, sf_dir), given.holidays(spark, sf_dir), years=given.EVENT_YEARS
    )
    plan = _plan(sla.verdict_of(visited))
    rows = plan.split("Subquery")[0] + plan[plan.rindex("== Initial Plan ==") :]
    assert "Join" not in rows
    assert rows.count("Exchange hashpartitioning") == 2  # by ticket and export, by ticket
    assert rows.count("Window [") == 1


def test_copies_are_dropped_before_the_shuffle(spark, sf_dir):
    plan = _plan(queries.QUERIES["override_output"](spark, sf_dir))
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below


def test_tickets_are_summed_before_they_are_doubled(spark):
    df = indicators.rollups(spark.createDataFrame(_random_tickets(3), TICKETS))
    plan = _plan(df)
    below = plan[plan.index("Expand"):]
    assert below.count("HashAggregate") == 2


def test_small_categories_are_broadcast(spark):
    df = indicators.indicators(
        spark.createDataFrame(_random_tickets(3), TICKETS), fx.categories(spark, CATEGORY_ROWS)
    )
    assert _plan(df).count("BroadcastHashJoin") == 2


def test_history_scan_reads_only_its_columns(spark, tmp_path):
    path = str(tmp_path / "h")
    fx.history(spark).withColumn("sobrante", F.lit("x")).write.parquet(path)
    df = sla.ticket_verdict(spark.read.parquet(path), fx.holidays(spark))
    assert "sobrante" not in _plan(df)


def test_sums_do_not_depend_on_the_partitioning(spark):
    rng = random.Random(8)
    rows = [
        (str(i), "P", f"F{i % 2 + 1}", "A", float(rng.randint(1, 9)), repr(rng.uniform(0.1, 10.0) * 10 ** rng.randint(-4, 4)), "1.0", "m")
        for i in range(3000)
    ]
    seen = set()
    for parts in range(1, 12):
        df = spark.createDataFrame(rows, TICKETS).repartition(parts, "id_ticket")
        found = indicators.rollups(df).collect() + indicators.rollup_by_sql(df, 1, ["F1"]).collect()
        seen.add(tuple(sorted(map(repr, found))))
    assert len(seen) == 1
    exact = math.fsum(float(r[5]) for r in rows if r[2] == "F1")
    sums = {r.total_tiempo for r in indicators.rollup_by_sql(df, 1, ["F1"]).collect()}
    assert sums == {exact}
