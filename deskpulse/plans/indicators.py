"""Ticket list + categories -> monthly indicators in the standard row shape."""

from pyspark.sql import functions as F

from deskpulse.functions.text import request_key
from deskpulse.functions.values import number_or_null, number_or_zero
from deskpulse.operators.exact_sums import ROW, combined, spread, summed
from deskpulse.plans.categories import flows_by_branch, repaired_categories
from deskpulse.schemas import (
    ALL_REQUESTS,
    INDICATOR_COLUMNS,
    INDICATOR_TYPES,
    KEY_REPAIRS,
    NAME_REPAIRS,
)

SUMS = ("volumen_total_casos", "total_tiempo", "sum_casos_ok")
TICKET_KEYS = ("proyecto", "flujo", "tipo_solicitud", "date")
ROLLUP_KEYS = ("Id", "fecha", "proyecto", "flujo", "tipo_solicitud")


def _numbers(tickets, zero_fill=False):
    """The numbers of tickets in the rows that exact sums are made of."""
    number = number_or_zero if zero_fill else number_or_null
    named = ("volumen_total_casos", "diferencia_tiempo_festivos", "sum_casos_ok")
    return spread(tickets, TICKET_KEYS, {name: number(c) for name, c in zip(SUMS, named)})


def request_sums(tickets, zero_fill=False):
    """Sums per project, flow, request type and month; unreadable numbers are skipped."""
    return combined(_numbers(tickets, zero_fill), TICKET_KEYS, SUMS)


def rollups(tickets, zero_fill=False):
    """Both rollups at once: over all requests ('Todas') and per request type.

    The tickets are read and grouped once. The grouping sets run over those sums,
    so only they are doubled, never the tickets.
    """
    keys = [*ROLLUP_KEYS, "all_requests"]
    ratios = {
        "ratio_ok": F.try_divide("sum_casos_ok", "volumen_total_casos"),
        "ratio_tiempop": F.try_divide("total_tiempo", "volumen_total_casos"),
    }
    rolled = combined(_exact_rollups(tickets, zero_fill), keys, SUMS).withColumns(ratios)
    return rolled.select(*ROLLUP_KEYS, *SUMS, *ratios, "all_requests")


def _exact_rollups(tickets, zero_fill):
    """Both rollups as rows of exact sums: they become doubles once, at the end."""
    sums = summed(_numbers(tickets, zero_fill), TICKET_KEYS)
    some = ["proyecto", "flujo", "date", "_measure", "_bin"]
    grouped = sums.groupingSets(
        [some, [*some, "tipo_solicitud"]], *TICKET_KEYS, "_measure", "_bin"
    ).agg(
        (F.grouping("tipo_solicitud") == 1).alias("all_requests"),
        F.sum("_part").alias("_part"),
    )
    return grouped.select(
        F.when(F.col("all_requests"), 1).otherwise(2).alias("Id"),
        F.col("date").alias("fecha"),
        "proyecto",
        "flujo",
        F.when(F.col("all_requests"), ALL_REQUESTS)
        .otherwise(F.col("tipo_solicitud"))
        .alias("tipo_solicitud"),
        *ROW,
        "all_requests",
    )


def for_listed_flows(rolled, categories):
    """Rollups per indicator type, kept where a category of the type lists the flow."""
    return rolled.join(flows_by_branch(categories), ["all_requests", "flujo"])


def categorised(tickets, categories, zero_fill=False):
    """Rollups with the categories they feed, sums as doubles; see ``_categorised``."""
    keys = [*ROLLUP_KEYS, "all_requests"]
    rolled = combined(_exact_rollups(tickets, zero_fill), keys, SUMS)
    return _categorised(rolled, categories, SUMS)


def _categorised(rolled, categories, values=ROW):
    """Rollups joined to their categories by type and project_flow_request key.

    The key alone decides, not the branch: a ticket whose own request type is 'Todas'
    also feeds the category over all requests. Repeated categories repeat rows.
    """
    keyed = for_listed_flows(rolled, categories).select(
        "tipo_indicador",
        request_key("proyecto", "flujo", "tipo_solicitud").alias("id_pro_flu_sol"),
        "fecha",
        *values,
    )
    wanted = categories.select(
        "tipo_indicador", "id_pro_flu_sol", "id_grupo", "id_indicador", "nombre_indicador"
    )
    return keyed.join(wanted, ["tipo_indicador", "id_pro_flu_sol"])


def measured(fed):
    """One value per indicator and month, in the 13-column shape."""
    volume, time, ok = (F.col(name) for name in SUMS)
    kind = F.col("tipo_indicador")
    value = (
        F.when(kind == "Q", volume)
        .when(kind == "ANS", F.try_divide(time, volume))
        .when(kind == "KPI", F.try_divide(ok, volume))
    )
    keys = ["id_grupo", "id_indicador", "nombre_indicador", "tipo_indicador", "fecha"]
    blank = F.lit("")
    return (
        combined(fed.filter(kind.isin(*INDICATOR_TYPES)), keys, SUMS)
        .select(
            F.lit(0).alias("tipo_reg"),
            F.col("id_indicador").alias("id"),
            F.col("nombre_indicador").alias("nombre"),
            "fecha",
            value.alias("valor"),
            *[blank.alias(c) for c in ("valor_ant", "medida1", "medida2", "medida3")],
            F.col("id_grupo").alias("aplicacion_proceso"),
            *[blank.alias(c) for c in ("alegacion", "calibracion", "descripcion")],
        )
        .select(*INDICATOR_COLUMNS)
    )


def indicators(
    tickets,
    raw_categories,
    types=INDICATOR_TYPES,
    zero_fill=False,
    mappings=(NAME_REPAIRS, KEY_REPAIRS),
):
    """Monthly volume (Q), mean net days per case (ANS) and share inside the limit (KPI).

    ``mappings`` repair the spellings of the categories.
    """
    categories = repaired_categories(raw_categories, mappings).filter(
        F.col("tipo_indicador").isin(*types)
    )
    return measured(_categorised(_exact_rollups(tickets, zero_fill), categories))


def indicator_totals(tickets, raw_categories, kind):
    """Totals per indicator over all months, to check ANS (time) or KPI (cases)."""
    if kind not in ("ANS", "KPI"):
        raise ValueError(f"kind must be ANS or KPI, not {kind}")
    categories = repaired_categories(raw_categories).filter(F.col("tipo_indicador") == kind)
    name, measure = ("tiempo", "total_tiempo") if kind == "ANS" else ("sum_casos_ok",) * 2
    fed = _categorised(_exact_rollups(tickets, False), categories)
    totals = combined(fed, ["id_indicador"], ("volumen_total_casos", measure))
    return totals.select(
        F.lit(0).alias("tipo_reg"),
        F.col("id_indicador").alias("id"),
        F.col("volumen_total_casos").alias("nombre"),
        F.col(measure).alias(name),
    )


ROLLUP_BY_SQL = """
SELECT :branch AS Id, date AS fecha, proyecto, flujo,
       CASE WHEN :branch = 1 THEN :all_requests ELSE tipo_solicitud END AS tipo_solicitud,
       _measure, _bin, sum(_part) AS _part
FROM {numbers}
WHERE array_contains(CAST(:flows AS array<string>), flujo)
GROUP BY date, proyecto, flujo,
         CASE WHEN :branch = 1 THEN :all_requests ELSE tipo_solicitud END, _measure, _bin
"""


def rollup_by_sql(tickets, branch, flows):
    """One rollup as SQL, all values and the table passed as parameters.

    The frame with the tickets' numbers stands for ``{numbers}`` under a view name of its own.
    """
    rolled = tickets.sparkSession.sql(
        ROLLUP_BY_SQL,
        args={
            "branch": branch,
            "all_requests": ALL_REQUESTS,
            "flows": F.array(*[F.lit(f) for f in flows]),
        },
        numbers=_numbers(tickets),
    )
    return combined(rolled, ROLLUP_KEYS, SUMS)
