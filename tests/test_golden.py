"""The hand-worked example through all jobs."""

import pytest

from deskpulse import (
    indicators,
    primary_output,
    publish,
    state_detail,
    ticket_list,
    ticket_verdict,
    verdict_table,
)
from tests import fixtures as fx


@pytest.mark.parametrize("scope", ["ticket", "file"])
@pytest.mark.parametrize("split_rows", [2, 1_000_000])
def test_detail(spark, scope, split_rows):
    rows = state_detail(
        fx.history(spark), fx.holidays(spark), scope=scope, split_rows=split_rows
    ).orderBy("fecha").collect()
    got = sorted(tuple(r)[4:] + (r.id_ticket,) for r in rows)
    assert got == sorted(
        [
            ("En Validación", "06/05/2020 09:00:00 AM +00:00", "20200605", "0.0", "3.00", "3.00", "T1"),
            ("Cerrado", "08/06/2020 09:00:00 +00:00", "20200608", "2.0", "3.00", "1.00", "T1"),
            ("Cerrado", "15/06/2020 12:00:00 +00:00", "20200615", "5.0", "14.00", "9.00", "T2"),
        ]
    )


@pytest.mark.parametrize("scope", ["ticket", "file"])
@pytest.mark.parametrize("split_rows", [2, 1_000_000])
def test_verdict(spark, scope, split_rows):
    verdicts = verdict_table(
        ticket_verdict(fx.history(spark), fx.holidays(spark), scope=scope, split_rows=split_rows),
        sort=True,
    )
    assert [tuple(r) for r in verdicts.collect()] == [
        ("T1", "20200608", 518400.0, "2.0", "4.0", "6.0", "OK"),
        ("T2", "20200615", 1209600.0, "5.0", "9.0", "14.0", "KO"),
    ]


def _tickets(spark):
    verdicts = verdict_table(ticket_verdict(fx.history(spark), fx.holidays(spark)))
    return ticket_list(fx.description(spark), verdicts)


def test_ticket_list(spark):
    tickets = _tickets(spark)
    assert tickets.columns[-1] == "date"
    got = {
        r.id_ticket: (r.volumen_total_casos, r.total_casos_ok, r.sum_casos_ok, r.date, r.user_name)
        for r in tickets.collect()
    }
    assert got == {
        "T1": (1.0, 0.0, "1.0", "01/06/2020", "0.0"),
        "T2": (4.0, 1.0, "0.0", "01/06/2020", "ana"),
    }


def test_indicators_and_outputs(spark):
    computed = indicators(_tickets(spark), fx.categories(spark, fx.CATEGORIES))
    got = {r.id: (r.fecha, r.valor, r.aplicacion_proceso) for r in computed.collect()}
    assert got == {
        "I1": ("01/06/2020", 5.0, "G"),
        "I2": ("01/06/2020", 2.6, "G"),
        "I3": ("01/06/2020", 0.2, "G"),
        "I4": ("01/06/2020", 4.0, "G"),
    }
    landed = fx.standard(spark, [("S1", "01/06/2020", "G", "7"), ("S1", "01/06/2020", "G", "8")])
    primary = primary_output(landed, computed)
    values = {r.id: r.valor for r in primary.collect()}
    assert values == {"I1": "5,0", "I2": "2,6", "I3": "0,2", "I4": "4,0", "S1": "7"}
    assert primary.count() == 5

    claims = fx.standard(
        spark, [("I2", "01/06/2020", "G", "1,9"), ("I9", "01/06/2020", "G", "3,3")]
    )
    final = {r.id: r.valor for r in publish(primary, claims).collect()}
    assert final == {**values, "I2": "1,9", "I9": "3,3"}
    kept = {r.id: r.valor for r in publish(primary, claims, "passthrough").collect()}
    assert kept == values
