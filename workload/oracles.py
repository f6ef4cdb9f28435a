"""The same results in SQL, from the same tables.

Written as chains of named steps; each query lists the steps it needs and a SELECT.
"""

from deskpulse.schemas import KEY_REPAIRS, NAME_REPAIRS

WORKING = "('En Validación', 'En gestión', 'En validación', 'En Gestión', 'Validación')"
FORMAT_24H = "%d/%m/%Y %H:%M:%S +00:00"
FORMAT_12H = "%m/%d/%Y %I:%M:%S %p +00:00"

STEPS = {
    # event history, one export per week
    "history": f"""
        SELECT CAST(user_id AS VARCHAR) AS id_ticket,
               CASE event_type WHEN 'signup' THEN 'Crear ticket' WHEN 'view' THEN 'En gestión'
                    WHEN 'click' THEN 'En Validación'
                    WHEN 'error' THEN NULL ELSE event_type END AS estado,
               CASE WHEN event_id % 2 = 0 THEN strftime(ts, '{FORMAT_24H}')
                    ELSE strftime(ts, '{FORMAT_12H}') END AS fecha,
               strftime(date_trunc('week', ts), '%Y%m%d') AS date,
               event_id AS row_seq,
               date_trunc('second', ts) AS start_ts
        FROM events""",
    "led_ticket": """
        SELECT *, lead(row_seq) OVER w AS n_seq, lead(estado) OVER w AS n_estado,
               lead(fecha) OVER w AS n_fecha, lead(start_ts) OVER w AS n_ts
        FROM history WINDOW w AS (PARTITION BY id_ticket, date ORDER BY start_ts, row_seq)""",
    "led_file": """
        SELECT *, lead(row_seq) OVER w AS n_seq, lead(estado) OVER w AS n_estado,
               lead(fecha) OVER w AS n_fecha, lead(start_ts) OVER w AS n_ts
        FROM history WINDOW w AS (ORDER BY row_seq)""",
    # days and how many of them are off
    "event_off": """
        SELECT make_date(2024, 1, 1 + 7 * r_regionkey) AS day FROM region""",
    "order_off": """
        SELECT make_date(CAST(y AS INTEGER), 1, 1 + 7 * r_regionkey) AS day
        FROM region, range(1995, 2003) AS years(y)""",
    "event_calendar": """
        SELECT day, off, sum(off) OVER (ORDER BY day) AS upto
        FROM (SELECT CAST(d AS DATE) AS day,
                     CASE WHEN isodow(d) >= 6 OR CAST(d AS DATE) IN (SELECT day FROM event_off)
                          THEN 1 ELSE 0 END AS off
              FROM range(TIMESTAMP '2023-12-01', TIMESTAMP '2025-01-01', INTERVAL 1 DAY) AS r(d))""",
    "order_calendar": """
        SELECT day, off, sum(off) OVER (ORDER BY day) AS upto
        FROM (SELECT CAST(d AS DATE) AS day,
                     CASE WHEN isodow(d) >= 6 OR CAST(d AS DATE) IN (SELECT day FROM order_off)
                          THEN 1 ELSE 0 END AS off
              FROM range(TIMESTAMP '1994-01-01', TIMESTAMP '2004-01-01', INTERVAL 1 DAY) AS r(d))""",
    "intervals": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CAST(l_shipdate AS DATE) AS end_day, CAST(o_orderdate AS DATE) AS begin_day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "interval_counts": """
        SELECT i.*, CAST(CASE WHEN end_day >= begin_day THEN e.upto - b.upto + b.off ELSE 0 END AS DOUBLE) AS days_off,
               CASE WHEN end_day >= begin_day THEN end_day - begin_day + 1 ELSE 0 END AS whole_days
        FROM intervals i JOIN order_calendar b ON b.day = begin_day JOIN order_calendar e ON e.day = end_day""",
    # standard rows
    "claims": """
        SELECT 1::BIGINT AS tipo_reg,
               CASE WHEN p_type = 'ECONOMY' THEN p_brand || '-' || p_type ELSE 'nuevo ' || p_name END AS id,
               'alegación' AS nombre,
               '01/' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '/2024' AS fecha, '1,9' AS valor,
               '' AS valor_ant, '' AS medida1, '' AS medida2, '' AS medida3,
               p_type AS "aplicación_proceso", '' AS "alegación",
               CAST(p_size % 12 + 1 AS VARCHAR) AS "calibración", 'externo' AS "descripción"
        FROM part
        UNION ALL
        SELECT 1, 'nuevo ' || c_name, 'alegación',
               '01/' || lpad(CAST(c_nationkey % 12 + 1 AS VARCHAR), 2, '0') || '/2024', '2,5',
               '', '', '', '', 'ventas', '', CAST(c_nationkey % 12 + 1 AS VARCHAR), 'externo'
        FROM customer""",
    # order tickets
    "order_desc": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id_ticket, c_mktsegment AS proyecto, o_orderpriority AS flujo,
               CASE WHEN o_orderkey % 51 = 0 THEN NULL WHEN o_orderkey % 50 = 0 THEN 'Todas'
                    ELSE o_orderstatus END AS tipo_solicitud,
               CAST(c_nationkey AS VARCHAR) AS pais, o_totalprice AS importe,
               CASE WHEN o_orderkey % 37 = 0 THEN 'NaN'::DOUBLE WHEN o_orderkey % 40 = 0 THEN -1.0
                    ELSE lines END::DOUBLE AS volumen_total_casos,
               CASE WHEN o_orderkey % 30 = 0 THEN -1.0 ELSE returned END::DOUBLE AS total_casos_ok,
               user_name, strftime(o_orderdate, '%Y%m%d') AS date
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT l_orderkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'A') AS returned
                   FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
        CROSS JOIN LATERAL (VALUES (c_name), (NULL)) AS u(user_name)""",
    "order_verdict": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id_ticket,
               CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE strftime(o_orderdate, '%Y%m%d') END AS date,
               o_totalprice AS "Diferencia_tiempo", '0.0' AS dias_festivos,
               o_totalprice / 86400.0 AS diferencia_tiempo_festivos,
               o_totalprice / 86400.0 AS "Diferencia_tiempo_dias",
               CASE WHEN o_totalprice / 86400.0 >= 5.0 THEN 'KO' ELSE 'OK' END AS ok_ko
        FROM orders""",
    "order_tickets": """
        SELECT id_ticket, proyecto, flujo, tipo_solicitud, pais, importe, volumen_total_casos, total_casos_ok,
               user_name, "Diferencia_tiempo", dias_festivos, diferencia_tiempo_festivos,
               "Diferencia_tiempo_dias", ok_ko,
               CASE WHEN ok_ko = 'OK' THEN volumen_total_casos ELSE 0.0 END AS ok_cases, date
        FROM (
            SELECT d.id_ticket, d.proyecto, d.flujo, coalesce(d.tipo_solicitud, '0.0') AS tipo_solicitud,
                   d.pais, d.importe,
                   CASE WHEN coalesce(d.volumen_total_casos, 0) IN (0, -1) OR isnan(d.volumen_total_casos) THEN 1.0
                        ELSE d.volumen_total_casos END AS volumen_total_casos,
                   CASE WHEN d.total_casos_ok = -1 THEN 1.0 ELSE coalesce(d.total_casos_ok, 0.0) END AS total_casos_ok,
                   coalesce(d.user_name, '0.0') AS user_name, v.* EXCLUDE (id_ticket, date),
                   CASE WHEN v.date <> '0' THEN '01/' || v.date[5:6] || '/' || v.date[1:4] END AS date
            FROM order_desc d JOIN order_verdict v ON d.id_ticket = v.id_ticket)
        QUALIFY row_number() OVER (PARTITION BY id_ticket, proyecto, flujo, date
                                   ORDER BY tipo_solicitud, pais, importe, volumen_total_casos,
                                            total_casos_ok, user_name) = 1""",
    # tickets of the event history
    "customer_desc": """
        SELECT CAST(c_custkey AS VARCHAR) AS id_ticket, c_mktsegment AS proyecto,
               'Flujo ' || CAST(c_nationkey % 4 AS VARCHAR) AS flujo,
               CASE c_nationkey % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'F' ELSE 'P' END AS tipo_solicitud,
               CASE WHEN c_custkey % 4 = 0 THEN 1.0 ELSE c_custkey % 4 END::DOUBLE AS volumen_total_casos
        FROM customer""",
}

STEPS["hot"] = """
        SELECT * REPLACE (CASE WHEN user_id % 10 = 0 THEN user_id ELSE 0 END AS user_id) FROM events"""
STEPS["history_hot"] = STEPS["history"].replace("FROM events", "FROM hot")
STEPS["history_sparse"] = "SELECT * REPLACE (row_seq * 10000000 AS row_seq) FROM history"
STEPS["led_sparse"] = STEPS["led_file"].replace("FROM history", "FROM history_sparse")
STEPS["led_hot"] = STEPS["led_ticket"].replace("FROM history", "FROM history_hot")

LED_COLUMNS = "row_seq, id_ticket, estado, next_state, next_time, has_next"


def _cut(led):
    """Nothing follows a row whose next row opens a ticket."""
    gone = "n_seq IS NULL OR coalesce(n_estado IN ('Crear ticket', 'Crear Ticket'), false)"
    return f"""
        SELECT id_ticket, estado, fecha, date, row_seq, start_ts,
               CASE WHEN {gone} THEN 0 ELSE 1 END AS has_next,
               CASE WHEN {gone} THEN NULL ELSE n_estado END AS next_state,
               CASE WHEN {gone} THEN NULL ELSE n_fecha END AS next_time,
               CASE WHEN {gone} THEN NULL ELSE n_ts END AS end_ts
        FROM {led}"""


def _visits(cut):
    return f"""
        SELECT v.*, CAST(end_ts AS DATE) AS end_day,
               CAST(coalesce(date_diff('second', start_ts, end_ts), 0) AS DOUBLE) AS seconds,
               CAST(CASE WHEN CAST(end_ts AS DATE) >= CAST(start_ts AS DATE)
                         THEN e.upto - b.upto + b.off ELSE 0 END AS DOUBLE) AS off_days
        FROM {cut} v JOIN event_calendar b ON b.day = CAST(start_ts AS DATE)
        LEFT JOIN event_calendar e ON e.day = CAST(end_ts AS DATE)"""


STEPS["cut_ticket"] = _cut("led_ticket")
STEPS["cut_file"] = _cut("led_file")
STEPS["cut_sparse"] = _cut("led_sparse")
STEPS["cut_hot"] = _cut("led_hot")
STEPS["visits_ticket"] = _visits("cut_ticket")
STEPS["visits_file"] = _visits("cut_file")
STEPS["closing"] = """
        SELECT id_ticket, date AS date_particion, max(coalesce(strftime(end_day, '%Y%m%d'), '0')) AS date
        FROM visits_ticket GROUP BY id_ticket, date"""
STEPS["totals"] = f"""
        SELECT s.*, c.date
        FROM (SELECT id_ticket, date AS date_particion, sum(seconds) AS seconds, sum(off_days) AS off_days
              FROM visits_ticket WHERE estado IN {WORKING} OR estado IS NULL GROUP BY id_ticket, date) s
        JOIN closing c USING (id_ticket, date_particion)"""
STEPS["verdicts"] = """
        SELECT id_ticket, date, seconds, off_days, seconds / 86400.0 AS days,
               greatest(seconds / 86400.0 - off_days, 0.0) AS net_days,
               CASE WHEN greatest(seconds / 86400.0 - off_days, 0.0) >= 1.0 THEN 'KO' ELSE 'OK' END AS ok_ko
        FROM totals
        QUALIFY row_number() OVER (PARTITION BY id_ticket ORDER BY date_particion) = 1"""


def _landed_rows(source, id_, name, value, process, month):
    return f"""
        SELECT 1::BIGINT AS tipo_reg, {id_} AS id, {name} AS nombre,
               '01/' || lpad(CAST({month} AS VARCHAR), 2, '0') || '/2024' AS fecha,
               CAST({value} AS VARCHAR) AS valor, '' AS valor_ant, '' AS medida1, '' AS medida2,
               '' AS medida3, {process} AS "aplicación_proceso", '' AS "alegación",
               CAST({month} AS VARCHAR) AS "calibración", 'externo' AS "descripción"
        FROM {source}"""


_PART = ("part", "p_brand || '-' || p_type", "p_name", "p_size", "p_type", "p_size % 12 + 1")
STEPS["landed"] = " UNION ALL ".join(
    [
        _landed_rows(*_PART),
        _landed_rows(*_PART),
        _landed_rows("part", "p_brand", *_PART[2:]),
        _landed_rows("supplier", "s_name", "'proveedor'", "s_nationkey", "'compras'", "s_nationkey % 12 + 1"),
        _landed_rows("customer", "c_name", "c_mktsegment", "c_nationkey", "'ventas'", "c_nationkey % 12 + 1"),
        _landed_rows("nation", "n_name", "'nación'", "n_regionkey", "'países'", "n_nationkey % 12 + 1"),
    ]
)
KEY = 'id, fecha, "aplicación_proceso"'
REST = 'tipo_reg, nombre, valor, valor_ant, medida1, medida2, medida3, "alegación", "calibración", "descripción"'
STANDARD = (
    "tipo_reg, id, nombre, fecha, valor, valor_ant, medida1, medida2, medida3, "
    '"aplicación_proceso", "alegación", "calibración", "descripción"'
)


def _one_per_key(source, order=REST):
    return f"SELECT {STANDARD} FROM {source} QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY {order}) = 1"


def _categories(seen):
    return f"""
        SELECT kind || '-' || proyecto || '-' || flujo AS id_indicador, kind AS tipo_indicador,
               'Indicador ' || kind AS nombre_indicador, proyecto, proyecto AS id_grupo, flujo, tipo_solicitud,
               lower(proyecto || '_' || flujo || '_' || tipo_solicitud) AS id_pro_flu_sol
        FROM (
            SELECT proyecto, flujo, 'Todas' AS tipo_solicitud, kind
            FROM {seen}, (VALUES ('Q'), ('ANS'), ('KPI')) AS k(kind)
            UNION
            SELECT proyecto, flujo, coalesce(tipo_solicitud, 'Sin tipo'),
                   CASE tipo_solicitud WHEN 'O' THEN 'Q' WHEN 'F' THEN 'ANS' ELSE 'KPI' END
            FROM {seen})
        WHERE NOT (tipo_solicitud = 'Todas' AND (kind, flujo) IN (('ANS', '5-LOW'), ('KPI', 'Flujo 0')))"""


STEPS["order_categories"] = _categories("order_desc")
STEPS["customer_categories"] = _categories("customer_desc")



def _exact(number):
    """The sum of doubles in units of 2**-64, which is exact for the numbers of these tables."""
    return f"sum(CAST({number} * pow(2, 64) AS HUGEINT))"


def _double(exact):
    """Through the text, which is rounded once."""
    return f"CAST(CAST({exact} AS VARCHAR) AS DOUBLE) / pow(2, 64)"


# Exact sums of doubles, rounded once at the end.
SUMS = (
    f"{_exact('volumen_total_casos')} AS volumen_total_casos, {_exact('net')} AS total_tiempo, "
    f"{_exact('ok_cases')} AS sum_casos_ok"
)
DOUBLE_SUMS = ", ".join(
    f"{_double(name)} AS {name}" for name in ("volumen_total_casos", "total_tiempo", "sum_casos_ok")
)


def _rollup(source, branch, where="true"):
    request = "'Todas'" if branch == 1 else "tipo_solicitud"
    return f"""
        SELECT {branch} AS "Id", date AS fecha, proyecto, flujo, {request} AS tipo_solicitud, {SUMS}
        FROM {source} WHERE {where} GROUP BY proyecto, flujo, date, {request}"""


def _fed(source, categories):
    """Six separate rollups, each kept for the flows its own categories list."""
    parts = []
    for kind in ("Q", "ANS", "KPI"):
        for branch, test in ((1, "="), (2, "<>")):
            flows = (
                f"flujo IN (SELECT flujo FROM {categories} "
                f"WHERE tipo_indicador = '{kind}' AND tipo_solicitud {test} 'Todas')"
            )
            parts.append(f"SELECT '{kind}' AS tipo_indicador, * FROM ({_rollup(source, branch, flows)})")
    union = " UNION ALL ".join(parts)
    return f"""
        SELECT r.tipo_indicador, c.id_pro_flu_sol, fecha, volumen_total_casos, total_tiempo, sum_casos_ok,
               c.id_grupo, c.id_indicador, c.nombre_indicador
        FROM ({union}) r JOIN {categories} c
          ON c.tipo_indicador = r.tipo_indicador
         AND c.id_pro_flu_sol = lower(r.proyecto || '_' || r.flujo || '_' || r.tipo_solicitud)"""


STEPS["order_net"] = "SELECT *, diferencia_tiempo_festivos AS net FROM order_tickets"
STEPS["order_fed"] = _fed("order_net", "order_categories")
STEPS["event_tickets"] = """
        SELECT d.*, v.net_days AS net, '01/' || v.date[5:6] || '/' || v.date[1:4] AS date,
               CASE WHEN ok_ko = 'OK' THEN volumen_total_casos ELSE 0.0 END AS ok_cases
        FROM customer_desc d
        JOIN (SELECT * REPLACE (CASE WHEN date = '0' THEN NULL ELSE date END AS date) FROM verdicts) v
          USING (id_ticket)"""
STEPS["event_fed"] = _fed("event_tickets", "customer_categories")

_VOLUME = _double("sum(volumen_total_casos)")
VALUES = {
    "Q": _VOLUME,
    "ANS": f"({_double('sum(total_tiempo)')}) / nullif({_VOLUME}, 0)",
    "KPI": f"({_double('sum(sum_casos_ok)')}) / nullif({_VOLUME}, 0)",
}


def _indicators(fed, kinds=("Q", "ANS", "KPI")):
    return " UNION ALL ".join(
        f"""SELECT 0 AS tipo_reg, id_indicador AS id, nombre_indicador AS nombre, fecha,
                   {VALUES[kind]} AS valor, '' AS valor_ant, '' AS medida1, '' AS medida2,
                   '' AS medida3, id_grupo AS aplicacion_proceso, '' AS alegacion, '' AS calibracion,
                   '' AS descripcion
            FROM {fed} WHERE tipo_indicador = '{kind}'
            GROUP BY id_grupo, id_indicador, nombre_indicador, tipo_indicador, fecha"""
        for kind in kinds
    )


STEPS["order_indicators"] = _indicators("order_fed")
STEPS["event_indicators"] = _indicators("event_fed")


def _primary(computed):
    return f"""
        SELECT * FROM ({_one_per_key("landed")})
        UNION
        SELECT CAST(tipo_reg AS BIGINT), id, nombre, fecha, replace(CAST(valor AS VARCHAR), '.', ','),
               valor_ant, medida1, medida2, medida3, aplicacion_proceso, alegacion, calibracion, descripcion
        FROM {computed}"""


STEPS["order_primary"] = _primary("order_indicators")
STEPS["event_primary"] = _primary("event_indicators")


def _override(primary):
    return f"""
        SELECT {STANDARD}
        FROM (SELECT '0' AS filtro, * FROM claims UNION ALL SELECT '1', * FROM {primary})
        QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY filtro, {REST}) = 1"""


def _with(select, *names):
    steps = ", ".join(f"{name} AS ({STEPS[name]})" for name in names)
    return f"WITH {steps} {select}"


LED = ("history", "led_ticket", "cut_ticket")
VISITED = (*LED, "event_off", "event_calendar", "visits_ticket")
VISITED_FILE = ("history", "led_file", "cut_file", "event_off", "event_calendar", "visits_file")
JUDGED = (*VISITED, "closing", "totals", "verdicts")
LISTED = ("order_desc", "order_verdict", "order_tickets")
FED = (*LISTED, "order_categories", "order_net", "order_fed")
DAYS = ("order_off", "order_calendar", "intervals", "interval_counts")
REPORTED = (
    *JUDGED, "customer_desc", "customer_categories", "event_tickets", "event_fed", "event_indicators",
    "landed", "event_primary", "claims",
)


def _detail(visits, more=""):
    return f"""
        SELECT {more} id_ticket, estado, fecha, date AS date_particion,
               CASE WHEN has_next = 0 THEN 'Nan' ELSE next_state END AS "Estadofinal",
               CASE WHEN has_next = 0 THEN 'Nan' ELSE next_time END AS "FechaFinal",
               coalesce(strftime(end_day, '%Y%m%d'), '0') AS date, CAST(off_days AS VARCHAR) AS dias_festivos,
               printf('%.2f', seconds / 86400.0) AS diferencia_tiempo_dias,
               printf('%.2f', greatest(seconds / 86400.0 - off_days, 0.0)) AS diferencia_tiempo_festivos
        FROM {visits} WHERE estado IN {WORKING} OR estado IS NULL"""


VERDICT_TEXT = """
        SELECT id_ticket, date, seconds AS "Diferencia_tiempo", CAST(off_days AS VARCHAR) AS dias_festivos,
               CAST(net_days AS VARCHAR) AS diferencia_tiempo_festivos,
               CAST(days AS VARCHAR) AS "Diferencia_tiempo_dias", ok_ko
        FROM verdicts ORDER BY id_ticket"""
INTERVAL = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(end_day AS VARCHAR) AS end_day, "
    "CAST(begin_day AS VARCHAR) AS begin_day, days_off"
)


def _text_map(mapping):
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    return ", ".join(f"({quote(k)}, {quote(v)})" for k, v in mapping.items())


def _listed(names):
    return "[" + ", ".join("'" + n + "'" for n in names) + "]"


def _rollup_with_ratios(branch):
    return f"""
        SELECT *, sum_casos_ok / nullif(volumen_total_casos, 0) AS ratio_ok,
               total_tiempo / nullif(volumen_total_casos, 0) AS ratio_tiempop
        FROM (SELECT * REPLACE ({DOUBLE_SUMS}) FROM ({_rollup("order_net", branch)}))"""


ORACLES = {
    "mixed_timestamp_parse": f"""
        SELECT o_orderkey,
               CASE WHEN o_orderkey % 2 = 0 THEN strftime(t, '{FORMAT_24H}') ELSE strftime(t, '{FORMAT_12H}') END AS fecha,
               CAST(epoch(t) AS BIGINT) AS epoch_seconds
        FROM (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS t FROM orders)""",
    "holiday_year_pin": """
        SELECT DISTINCT CAST(make_date(y, month(o_orderdate), day(o_orderdate)) AS VARCHAR) AS day
        FROM orders, (VALUES (2020), (2023)) AS years(y)
        WHERE NOT (y = 2023 AND month(o_orderdate) = 2 AND day(o_orderdate) = 29)""",
    "next_state": _with(f"SELECT {LED_COLUMNS} FROM cut_ticket", *LED),
    "next_state_file_order": _with(
        f"SELECT {LED_COLUMNS} FROM cut_file", "history", "led_file", "cut_file"
    ),
    "next_state_sparse": _with(
        f"SELECT {LED_COLUMNS} FROM cut_sparse", "history", "history_sparse", "led_sparse", "cut_sparse"
    ),
    "next_state_hot": _with(f"SELECT {LED_COLUMNS} FROM cut_hot", "hot", "history_hot", "led_hot", "cut_hot"),
    # the rows of the given file lie in the order of event_id
    "state_detail_numbered": _with(_detail("visits_file", "row_seq AS event_id,"), *VISITED_FILE),
    "state_durations": _with(
        """SELECT row_seq, CAST(CAST(start_ts AS DATE) AS VARCHAR) AS start_day,
                  CAST(end_day AS VARCHAR) AS end_day, seconds, off_days FROM visits_ticket""",
        *VISITED,
    ),
    "working_states": _with(
        f"""SELECT estado, count(*) AS visits FROM history
            WHERE estado IN {WORKING} OR estado IS NULL GROUP BY estado""",
        "history",
    ),
    "nonbusiness_days": _with(
        f"SELECT {INTERVAL}, CAST(whole_days - days_off AS DOUBLE) AS business_days FROM interval_counts",
        *DAYS,
    ),
    "nonbusiness_days_calendar": _with(f"SELECT {INTERVAL} FROM interval_counts", *DAYS),
    "state_detail": _with(_detail("visits_ticket"), *VISITED),
    "state_detail_file_order": _with(_detail("visits_file"), *VISITED_FILE),
    "closing_date": _with("SELECT * FROM closing", *VISITED, "closing"),
    "ticket_sla": _with(
        "SELECT id_ticket, date AS end_day, seconds, off_days, days, net_days, ok_ko FROM verdicts", *JUDGED
    ),
    "verdict_table": _with(VERDICT_TEXT, *JUDGED),
    "regroup_identity": _with(
        "SELECT id_ticket, date AS end_day, seconds, off_days FROM verdicts ORDER BY id_ticket", *JUDGED
    ),
    "earliest_partition": _with(
        """SELECT id_ticket, date, row_seq, estado FROM history
           QUALIFY row_number() OVER (PARTITION BY id_ticket ORDER BY date, row_seq) = 1""",
        "history",
    ),
    "ticket_list": _with(
        "SELECT * EXCLUDE (ok_cases, date), CAST(ok_cases AS VARCHAR) AS sum_casos_ok, date FROM order_tickets",
        *LISTED,
    ),
    "tickets_without_month": _with(
        "SELECT count(*) FILTER (date IS NULL) AS without_month FROM order_tickets", *LISTED
    ),
    "month_bucket": """
        SELECT o_orderkey, closed,
               CASE WHEN closed <> '0' THEN strftime(date_trunc('month', o_orderdate), '%d/%m/%Y') END AS date
        FROM (SELECT o_orderkey, o_orderdate,
                     CASE WHEN o_orderkey % 97 = 0 THEN '0' ELSE strftime(o_orderdate, '%Y%m%d') END AS closed
              FROM orders)""",
    "synonym_repair": f"""
        WITH names(old, new) AS (VALUES {_text_map(NAME_REPAIRS)}),
             keys(old, new) AS (VALUES {_text_map(KEY_REPAIRS)}),
             raw AS (
                SELECT p_partkey, p_name, p_brand, p_type,
                       {_listed([*NAME_REPAIRS, "Nombre correcto"])}[p_partkey % 6 + 1] AS name,
                       {_listed([*KEY_REPAIRS, "Proyecto_Flujo_Todas"])}[p_partkey % 10 + 1] AS key
                FROM part)
        SELECT CAST(p_partkey AS VARCHAR) AS id_indicador, 'Q' AS tipo_indicador, p_name AS nombre_indicador,
               p_brand AS proyecto, p_type AS id_grupo, coalesce(n.new, name) AS flujo,
               CASE WHEN p_partkey % 2 = 0 THEN 'Todas' ELSE coalesce(n.new, name) END AS tipo_solicitud,
               'fichero' AS fichero, lower(coalesce(k.new, key)) AS id_pro_flu_sol
        FROM raw LEFT JOIN names n ON n.old = name LEFT JOIN keys k ON k.old = key""",
    "cell_replacement": """
        SELECT n_nationkey, n_regionkey,
               CASE WHEN n_name IN ('NATION_1', 'NATION_2') THEN 'NATION_3' ELSE n_name END AS n_name
        FROM nation""",
    "cell_replacement_by_table": """
        SELECT s_suppkey, s_name,
               CASE WHEN n_regionkey < 3 THEN 'región ' || CAST(n_regionkey AS VARCHAR) ELSE n_name END AS n_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "label_split": _with(
        """SELECT tipo_indicador, CASE WHEN tipo_solicitud = 'Todas' THEN 1 ELSE 2 END AS branch,
                  proyecto, flujo, tipo_solicitud FROM order_categories""",
        "order_desc", "order_categories",
    ),
    "flow_membership": _with(
        """SELECT o_orderpriority AS flujo, o_orderkey FROM orders
           WHERE o_orderpriority IN (SELECT flujo FROM order_categories
                                     WHERE tipo_indicador = 'ANS' AND tipo_solicitud = 'Todas')""",
        "order_desc", "order_categories",
    ),
    "rollup_all_requests": _with(_rollup_with_ratios(1), *LISTED, "order_net"),
    "rollup_by_request": _with(_rollup_with_ratios(2), *LISTED, "order_net"),
    "rollup_parameterised": _with(
        f"""SELECT * REPLACE ({DOUBLE_SUMS}) FROM (
                {_rollup("order_net", 1, "flujo IN ('1-URGENT')")}
                UNION ALL
                {_rollup("order_net", 2, "flujo IN ('2-HIGH', '5-LOW')")})""",
        *LISTED, "order_net",
    ),
    "fill_zero_option": _with(
        """SELECT proyecto, flujo, tipo_solicitud, date[1:6] AS date,
                  sum(CASE WHEN isnan(volumen_total_casos) THEN 0.0 ELSE coalesce(volumen_total_casos, 0.0) END) AS volumen_total_casos,
                  sum(coalesce(TRY_CAST(user_name AS DOUBLE), 0.0)) AS total_tiempo,
                  sum(coalesce(total_casos_ok, 0.0)) AS sum_casos_ok
           FROM order_desc GROUP BY ALL""",
        "order_desc",
    ),
    "sums_any_size": """
        SELECT l_returnflag AS proyecto, CAST(l_linenumber AS VARCHAR) AS flujo, l_linestatus AS tipo_solicitud,
               strftime(l_shipdate, '%m/%Y') AS date,
               fsum(l_extendedprice * pow(10, l_partkey % 61 - 30)) AS volumen_total_casos,
               fsum(l_extendedprice * pow(10, l_partkey % 61 - 30)) AS total_tiempo,
               CAST(sum(l_quantity) AS DOUBLE) AS sum_casos_ok
        FROM lineitem GROUP BY ALL""",
    "composite_key_join": _with(
        f"SELECT * REPLACE ({DOUBLE_SUMS}) FROM order_fed", *FED
    ),
    "indicator_q": _with(_indicators("order_fed", ("Q",)), *FED),
    "indicator_ans": _with(_indicators("order_fed", ("ANS",)), *FED),
    "indicator_kpi": _with(_indicators("order_fed", ("KPI",)), *FED),
    "indicators_all": _with("SELECT * FROM order_indicators", *FED, "order_indicators"),
    "indicator_totals_ans": _with(
        f"""SELECT 0 AS tipo_reg, id_indicador AS id, {_VOLUME} AS nombre,
                  {_double("sum(total_tiempo)")} AS tiempo
           FROM order_fed WHERE tipo_indicador = 'ANS' GROUP BY id_indicador""",
        *FED,
    ),
    "indicator_totals_kpi": _with(
        f"""SELECT 0 AS tipo_reg, id_indicador AS id, {_VOLUME} AS nombre,
                  {_double("sum(sum_casos_ok)")} AS sum_casos_ok
           FROM order_fed WHERE tipo_indicador = 'KPI' GROUP BY id_indicador""",
        *FED,
    ),
    "landing_union": _with("SELECT DISTINCT * FROM landed", "landed"),
    "empty_landing": """
        SELECT 'lnd_narrow' AS table_name, CAST(12 AS INTEGER) AS columns, false AS taken,
               count(*) AS standard_rows FROM nation WHERE false""",
    "nan_text_zero": """
        SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN '0.0' ELSE CAST(p_retailprice AS VARCHAR) END AS valor
        FROM part""",
    "distinct_landed": _with(
        'SELECT DISTINCT * REPLACE (CAST("calibración" AS BIGINT) AS "calibración") FROM landed', "landed"
    ),
    "decimal_comma": """
        SELECT p_partkey, replace(CAST(p_retailprice AS VARCHAR), '.', ',') AS valor FROM part""",
    "decimal_comma_plain": """
        SELECT p_partkey,
               CASE WHEN e >= 0 THEN d || repeat('0', CAST(e AS BIGINT)) || ',0'
                    WHEN -e < length(d) THEN left(d, length(d) + e) || ',' || right(d, -e)
                    ELSE '0,' || repeat('0', CAST(-e - length(d) AS BIGINT)) || d END AS valor
        FROM (SELECT p_partkey, rtrim(digits, '0') AS d,
                     CAST(p_partkey % 33 - 11 + length(digits) - length(rtrim(digits, '0')) AS INTEGER) AS e
              FROM (SELECT p_partkey, CAST(p_partkey * 7919 % 999999937 + 1 AS VARCHAR) AS digits FROM part))""",
    "primary_output": _with(
        "SELECT * FROM order_primary", *FED, "order_indicators", "landed", "order_primary"
    ),
    "override_output": _with(_override("landed"), "landed", "claims"),
    "passthrough_output": _with(
        'SELECT DISTINCT * REPLACE (CAST("calibración" AS BIGINT) AS "calibración") FROM landed', "landed"
    ),
    "claimed_keys": _with(
        f"""SELECT count(*) AS overridden FROM landed WHERE (id, fecha, "aplicación_proceso") IN
            (SELECT ({KEY}) FROM claims)""",
        "landed", "claims",
    ),
    "union_of_claims": _with(
        """SELECT * REPLACE (CAST("calibración" AS BIGINT) AS "calibración")
           FROM (SELECT * FROM landed UNION SELECT * FROM claims)""",
        "landed", "claims",
    ),
    "service_report": _with(_override("event_primary"), *REPORTED),
    "input_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS records FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
    ),
    "state_job": _with(VERDICT_TEXT, *JUDGED),
    "staged_visits": _with("SELECT * FROM closing", *VISITED, "closing"),
    "state_job_detail": _with(_detail("visits_ticket"), *VISITED),
    "incremental_append": _with(_detail("visits_ticket"), *VISITED),
    "incremental_states": _with(VERDICT_TEXT, *JUDGED),
    "incremental_spanning": _with(VERDICT_TEXT, *JUDGED),
    "incremental_spanning_detail": _with(_detail("visits_ticket"), *VISITED),
    "incremental_states_detail": _with(_detail("visits_ticket"), *VISITED),
    "incremental_static_join": """
        SELECT user_id % 25 AS nation, event_id, event_type, n_name
        FROM events JOIN nation ON n_nationkey = user_id % 25""",
}
# Runs over growing folders give what one run over all rows gives.
for _name, _whole in (
    ("both_new", "ticket_list"),
    ("indicators", "indicators_all"),
    ("landing", "landing_union"),
    ("primary", "primary_output"),
    ("output", "override_output"),
):
    ORACLES[f"incremental_{_name}"] = ORACLES[_whole]
