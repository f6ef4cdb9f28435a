"""The registered queries: (spark, sf_dir) -> DataFrame."""

from pyspark.sql import functions as F

from deskpulse.functions import calendar, dates, text
from deskpulse.functions.values import (
    covers_all_requests,
    is_working,
    number_or_null,
)
from deskpulse.operators.columns import replace_cells
from deskpulse.operators.combine import members, split_by, union_distinct
from deskpulse.operators.counts import row_counts
from deskpulse.operators.dedupe import distinct_rows, earliest_per_key
from deskpulse.plans import categories as cats
from deskpulse.plans import durations, indicators, jobs, landing, publish, sla, tickets
from deskpulse.sources.tables import read_history, read_table, stage, unstage, work_folder
from deskpulse.streaming import incremental, maintained
from workload import tables as t

# Users of the event table stay below five net days, so the limit is one day here.
EVENT_LIMIT = 1.0


# --- times, durations, verdicts -------------------------------------------------


def mixed_timestamp_parse(spark, sf):
    seconds = F.col("o_orderkey") % 86400
    time = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + seconds)
    orders = t.table(spark, sf, "orders").select(
        "o_orderkey", t.two_spellings(time, "o_orderkey").alias("fecha")
    )
    return orders.select(
        "o_orderkey", "fecha", F.unix_seconds(dates.start_time("fecha")).alias("epoch_seconds")
    )


def holiday_year_pin(spark, sf):
    days = t.table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date")
    )
    return dates.holidays_in_years(days, (2020, 2023)).select(F.col("day").cast("string").alias("day"))


def _next_state(spark, sf, scope):
    led = durations.with_next_state(t.history(spark, sf), scope)
    return led.select(
        "row_seq", "id_ticket", "estado", "next_state", "next_time", F.col("has_next").cast("int").alias("has_next")
    )


def next_state(spark, sf):
    return _next_state(spark, sf, "ticket")


def next_state_file_order(spark, sf):
    return _next_state(spark, sf, "file")


SPARSE = 10_000_000


def next_state_sparse(spark, sf):
    """The next row of the log, with row numbers ten million apart and small slices."""
    spread = t.history(spark, sf).withColumn("row_seq", F.col("row_seq") * SPARSE)
    led = durations.with_next_state(spread, "file", split_rows=1000)
    return led.select(
        "row_seq", "id_ticket", "estado", "next_state", "next_time", F.col("has_next").cast("int").alias("has_next")
    )


def next_state_hot(spark, sf):
    """The next row of a ticket, with nine of ten events on one ticket and small slices."""
    user = F.when(F.col("user_id") % 10 == 0, F.col("user_id")).otherwise(0)
    events = t.table(spark, sf, "events").withColumn("user_id", user)
    led = durations.with_next_state(t.history_of(events), "ticket", split_rows=1000)
    return led.select(
        "row_seq", "id_ticket", "estado", "next_state", "next_time", F.col("has_next").cast("int").alias("has_next")
    )


def state_detail_numbered(spark, sf):
    """Detail in file order with row numbers taken from the file; the event id is kept."""
    numbered = read_history(spark, f"{sf}/events.parquet")
    history = t.history_of(numbered, F.col("row_seq"), "event_id")
    return durations.state_detail(
        history, t.holidays(spark, sf), keep=["event_id"], years=t.EVENT_YEARS, scope="file"
    )


def _visits(spark, sf, **options):
    return durations.visits(
        t.history(spark, sf), t.holidays(spark, sf), years=t.EVENT_YEARS, **options
    )


def state_durations(spark, sf):
    return _visits(spark, sf).select(
        "row_seq",
        dates.day_of("start_ts").cast("string").alias("start_day"),
        F.col("end_day").cast("string").alias("end_day"),
        "seconds",
        "off_days",
    )


def working_states(spark, sf):
    return t.history(spark, sf).filter(is_working("estado")).groupBy("estado").agg(
        F.count(F.lit(1)).alias("visits")
    )


def _intervals(spark, sf):
    orders = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("begin_day")
    )
    return (
        t.table(spark, sf, "lineitem")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.to_date("l_shipdate").alias("end_day"),
        )
        .join(orders, "l_orderkey")
    )


def _order_holidays(spark, sf):
    return dates.holidays_in_years(t.holidays(spark, sf), t.ORDER_YEARS)


def _interval_text(df):
    return df.withColumns({c: F.col(c).cast("string") for c in ("begin_day", "end_day")})


def nonbusiness_days(spark, sf):
    upto = calendar.holiday_counter(_order_holidays(spark, sf))
    counted = _intervals(spark, sf).withColumns(
        {
            "days_off": calendar.days_off("begin_day", "end_day", upto),
            "business_days": calendar.business_days("begin_day", "end_day", upto),
        }
    )
    return _interval_text(counted)


def nonbusiness_days_calendar(spark, sf):
    """The calendar runs from the first order to the last shipment; reversed pairs count 0."""
    first = t.table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")))
    last = t.table(spark, sf, "lineitem").agg(F.to_date(F.max("l_shipdate")))
    days = calendar.off_day_calendar(_order_holidays(spark, sf), first.scalar(), last.scalar())
    counted = calendar.with_days_off_by_calendar(
        _intervals(spark, sf), "begin_day", "end_day", days
    )
    return _interval_text(counted)


def state_detail(spark, sf):
    return durations.detail_of(_visits(spark, sf))


def state_detail_file_order(spark, sf):
    return durations.detail_of(_visits(spark, sf, scope="file"))


def closing_date(spark, sf):
    return sla.closing_days(_visits(spark, sf)).select(
        "id_ticket", "date_particion", dates.closing_text("end_day").alias("date")
    )


def ticket_sla(spark, sf):
    verdicts = sla.verdict_of(_visits(spark, sf), EVENT_LIMIT)
    return verdicts.withColumn("end_day", dates.closing_text("end_day"))


def verdict_table(spark, sf):
    verdicts = sla.verdict_table(sla.verdict_of(_visits(spark, sf), EVENT_LIMIT), sort=True)
    return verdicts


def regroup_identity(spark, sf):
    again = sla.regrouped(sla.verdict_of(_visits(spark, sf), EVENT_LIMIT))
    return again.withColumn("end_day", dates.closing_text("end_day")).orderBy("id_ticket")


def earliest_partition(spark, sf):
    return earliest_per_key(
        t.history(spark, sf).select("id_ticket", "date", "row_seq", "estado"), ["id_ticket"], "date"
    )


# --- ticket list and indicators ----------------------------------------------------


def _tickets(spark, sf):
    return tickets.ticket_list(t.order_description(spark, sf), t.order_verdicts(spark, sf))


def _categories(spark, sf):
    return t.order_categories(spark, sf)


def ticket_list(spark, sf):
    numbers = ("diferencia_tiempo_festivos", "Diferencia_tiempo_dias")
    return _tickets(spark, sf).withColumns({n: number_or_null(n) for n in numbers})


def tickets_without_month(spark, sf):
    return tickets.tickets_without_month(_tickets(spark, sf))


def month_bucket(spark, sf):
    closed = F.when(F.col("o_orderkey") % 97 == 0, "0").otherwise(
        F.date_format("o_orderdate", "yyyyMMdd")
    )
    orders = t.table(spark, sf, "orders").select("o_orderkey", closed.alias("closed"))
    return orders.withColumn("date", dates.month_text("closed"))


def synonym_repair(spark, sf):
    return cats.repaired_categories(t.misspelled_categories(spark, sf))


def cell_replacement(spark, sf):
    return replace_cells(
        t.table(spark, sf, "nation"), {"NATION_1": "NATION_2"}, {"NATION_2": "NATION_3"}
    )


def cell_replacement_by_table(spark, sf):
    """Suppliers with the names of their nations replaced by a mapping table."""
    nation = t.table(spark, sf, "nation")
    mapping = nation.filter("n_regionkey < 3").select(
        F.col("n_name").alias("old"), F.concat(F.lit("región "), F.col("n_regionkey").cast("string")).alias("new")
    )
    supplied = t.table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return replace_cells(supplied.select("s_suppkey", "s_name", "n_name"), mapping)


def label_split(spark, sf):
    raw = cats.repaired_categories(_categories(spark, sf))
    parts = []
    for kind in ("Q", "ANS", "KPI"):
        over_all, single = split_by(cats.of_type(raw, kind), covers_all_requests("tipo_solicitud"))
        parts += [over_all.withColumn("branch", F.lit(1)), single.withColumn("branch", F.lit(2))]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.select("tipo_indicador", "branch", "proyecto", "flujo", "tipo_solicitud")


def flow_membership(spark, sf):
    over_all = cats.of_type(cats.repaired_categories(_categories(spark, sf)), "ANS").filter(
        covers_all_requests("tipo_solicitud")
    )
    orders = t.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("flujo"))
    return members(orders, over_all, "flujo")


def _rollup(spark, sf, branch):
    return indicators.rollups(_tickets(spark, sf)).filter(F.col("Id") == branch).drop("all_requests")


def rollup_all_requests(spark, sf):
    return _rollup(spark, sf, 1)


def rollup_by_request(spark, sf):
    return _rollup(spark, sf, 2)


def rollup_parameterised(spark, sf):
    listed = _tickets(spark, sf)
    frames = [
        indicators.rollup_by_sql(listed, 1, ["1-URGENT"]),
        indicators.rollup_by_sql(listed, 2, ["2-HIGH", "5-LOW"]),
    ]
    return frames[0].unionByName(frames[1])


def fill_zero_option(spark, sf):
    lines = t.order_description(spark, sf).select(
        "proyecto",
        "flujo",
        "tipo_solicitud",
        "volumen_total_casos",
        F.substring("date", 1, 6).alias("date"),
        F.col("user_name").alias("diferencia_tiempo_festivos"),
        F.col("total_casos_ok").cast("string").alias("sum_casos_ok"),
    )
    return indicators.request_sums(lines, zero_fill=True)


def sums_any_size(spark, sf):
    """Sums of numbers from 1e-30 to 1e35, and of such that cancel but for the quantities."""
    power = F.pow(F.lit(10.0), (F.col("l_partkey") % 61 - 30).cast("double"))
    lines = t.table(spark, sf, "lineitem").withColumn("x", F.col("l_extendedprice") * power)
    numbers = F.posexplode(F.array("x", F.col("l_quantity").cast("double"), -F.col("x")))
    tickets = lines.select("*", numbers.alias("place", "number")).select(
        F.col("l_returnflag").alias("proyecto"),
        F.col("l_linenumber").cast("string").alias("flujo"),
        F.col("l_linestatus").alias("tipo_solicitud"),
        F.date_format("l_shipdate", "MM/yyyy").alias("date"),
        F.when(F.col("place") == 0, F.col("x")).alias("volumen_total_casos"),
        F.when(F.col("place") == 0, F.col("x").cast("string")).alias("diferencia_tiempo_festivos"),
        F.col("number").alias("sum_casos_ok"),
    )
    return indicators.request_sums(tickets)


def composite_key_join(spark, sf):
    return indicators.categorised(
        _tickets(spark, sf), cats.repaired_categories(_categories(spark, sf))
    )


def _indicators(spark, sf, types):
    return indicators.indicators(_tickets(spark, sf), _categories(spark, sf), types)


def indicator_q(spark, sf):
    return _indicators(spark, sf, ("Q",))


def indicator_ans(spark, sf):
    return _indicators(spark, sf, ("ANS",))


def indicator_kpi(spark, sf):
    return _indicators(spark, sf, ("KPI",))


def indicators_all(spark, sf):
    return _indicators(spark, sf, ("Q", "ANS", "KPI"))


def indicator_totals_ans(spark, sf):
    return indicators.indicator_totals(_tickets(spark, sf), _categories(spark, sf), "ANS")


def indicator_totals_kpi(spark, sf):
    return indicators.indicator_totals(_tickets(spark, sf), _categories(spark, sf), "KPI")


# --- landing and publishing ----------------------------------------------------------


def landing_union(spark, sf):
    standard, _ = landing.standardise(t.landing_tables(spark, sf))
    return standard


def empty_landing(spark, sf):
    """Only a table that does not fit: an empty standard table, and the report."""
    narrow = {"lnd_narrow": t.landing_tables(spark, sf)["lnd_narrow"]}
    standard, report = landing.standardise(narrow)
    standard_rows = standard.agg(F.count(F.lit(1)).alias("standard_rows"))
    return report.withColumn("standard_rows", standard_rows.scalar())


def nan_text_zero(spark, sf):
    """Prices as texts, some of them NaN, which counts as zero."""
    price = F.when(F.col("p_size") % 7 == 0, float("nan")).otherwise(F.col("p_retailprice"))
    parts = t.table(spark, sf, "part").select("p_partkey", price.alias("valor"))
    spelled = text.with_float_texts(parts, "valor")
    return spelled.withColumn("valor", text.nan_text_as_zero("valor"))


def distinct_landed(spark, sf):
    return distinct_rows(t.landed(spark, sf))


def decimal_comma(spark, sf):
    prices = t.table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("valor"))
    return text.with_comma_texts(prices, "valor")


def decimal_comma_plain(spark, sf):
    """One to nine digits per part, moved to between 1e-11 and 1e30."""
    key = F.col("p_partkey")
    digits = (key * 7919 % 999_999_937 + 1).cast("string")
    number = F.concat(digits, F.lit("E"), (key % 33 - 11).cast("string")).cast("double")
    return text.with_comma_texts(
        t.table(spark, sf, "part").select("p_partkey", number.alias("valor")), "valor", plain=True
    )


def _primary(spark, sf):
    standard, _ = landing.standardise(t.landing_tables(spark, sf))
    return publish.primary_output(standard, indicators_all(spark, sf))


def primary_output(spark, sf):
    return _primary(spark, sf)


def override_output(spark, sf):
    return publish.publish(t.landed(spark, sf), t.claims(spark, sf))


def passthrough_output(spark, sf):
    return publish.publish(t.landed(spark, sf), t.claims(spark, sf), "passthrough")


def claimed_keys(spark, sf):
    return publish.claimed_keys(t.landed(spark, sf), t.claims(spark, sf))


def union_of_claims(spark, sf):
    return union_distinct([t.landed(spark, sf), t.claims(spark, sf)])


def service_report(spark, sf):
    """All jobs in a row: history to published table."""
    description = t.customer_description(spark, sf)
    verdicts = sla.verdict_table(sla.verdict_of(_visits(spark, sf), EVENT_LIMIT))
    listed = tickets.ticket_list(description, verdicts)
    computed = indicators.indicators(listed, t.categories_of(description))
    standard, _ = landing.standardise(t.landing_tables(spark, sf))
    primary = publish.primary_output(standard, computed)
    return publish.publish(primary, t.claims(spark, sf))


# --- counts, jobs, incremental runs -----------------------------------------------------


def input_counts(spark, sf):
    names = (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    )
    return row_counts({n: t.table(spark, sf, n) for n in names})


def _run_state_job(spark, sf):
    folder = work_folder(spark, "state-job")
    jobs.run_states(
        t.history(spark, sf),
        t.holidays(spark, sf),
        f"{folder}/detail",
        f"{folder}/verdicts",
        sla_days=EVENT_LIMIT,
        options={"years": t.EVENT_YEARS},
    )
    return folder


def state_job(spark, sf):
    """The first job with its sinks; returns the verdict table it wrote."""
    return read_table(spark, f"{_run_state_job(spark, sf)}/verdicts")


def state_job_detail(spark, sf):
    """The first job; returns the detail table it wrote."""
    folder = _run_state_job(spark, sf)
    return read_table(spark, f"{folder}/detail")


def staged_visits(spark, sf):
    staged, _ = stage(_visits(spark, sf), "visits")
    return sla.closing_days(staged).select(
        "id_ticket", "date_particion", dates.closing_text("end_day").alias("date")
    )


def _in_two_runs(spark, name, frames, run):
    """run(streams, folder), twice, over folders that grow in between.

    ``frames`` maps names to (rows, part): the rows of part 0 land first, those of part 1
    after the first run. The rows are computed once, for both parts.
    """
    folder = work_folder(spark, name)
    staged = {source: stage(df.withColumn("_part", part), source) for source, (df, part) in frames.items()}
    for part in (0, 1):
        streams = {}
        for source, (df, _) in frames.items():
            place = f"{folder}/in/{source}"
            rows, _ = staged[source]
            rows.filter(F.col("_part") == part).drop("_part").write.mode("append").parquet(place)
            streams[source] = incremental.new_records(spark, place, df.schema)
        run(streams, folder)
    for _, path in staged.values():
        unstage(spark, path)
    return folder


def _by_user(spark, sf):
    """History rows; one half of the tickets lands first, the other half later."""
    return {"history": (t.history(spark, sf), F.col("id_ticket").cast("bigint") % 2)}


def incremental_append(spark, sf):
    """Detail of a history folder that grows between two runs."""
    holidays = t.holidays(spark, sf)

    def run(streams, folder):
        incremental.append_state_detail(
            streams["history"], holidays, f"{folder}/checkpoint", f"{folder}/detail", years=t.EVENT_YEARS
        )

    folder = _in_two_runs(spark, "incremental-append", _by_user(spark, sf), run)
    return incremental.read_appended(spark, f"{folder}/detail")


def incremental_static_join(spark, sf):
    """New events against the whole nation table."""
    nations = t.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("nation"), "n_name"
    )
    events = t.table(spark, sf, "events").select(
        "event_id", "event_type", (F.col("user_id") % 25).alias("nation")
    )

    def run(streams, folder):
        incremental.join_new(
            streams["events"], nations, ["nation"], f"{folder}/checkpoint", f"{folder}/joined"
        )

    frames = {"events": (events, F.col("event_id") % 2)}
    folder = _in_two_runs(spark, "incremental-join", frames, run)
    return incremental.read_appended(spark, f"{folder}/joined")


def _incremental_states(spark, sf):
    holidays = t.holidays(spark, sf)

    def run(streams, folder):
        incremental.append_states(
            streams["history"], holidays, f"{folder}/checkpoint", f"{folder}/detail",
            f"{folder}/verdicts", sla_days=EVENT_LIMIT, years=t.EVENT_YEARS,
        )

    return _in_two_runs(spark, "incremental-states", _by_user(spark, sf), run)


def incremental_states(spark, sf):
    """First job over two runs: the verdict table."""
    return incremental.read_appended(spark, f"{_incremental_states(spark, sf)}/verdicts")


def incremental_states_detail(spark, sf):
    """First job over two runs: the detail table, written from the same batches."""
    return incremental.read_appended(spark, f"{_incremental_states(spark, sf)}/detail")


def _spanning(spark, sf):
    """Every ticket has records in both runs."""
    holidays = t.holidays(spark, sf)

    def run(streams, folder):
        maintained.maintain_states(
            streams["history"], holidays, f"{folder}/checkpoint", f"{folder}/tables",
            sla_days=EVENT_LIMIT, buckets=8, years=t.EVENT_YEARS,
        )

    frames = {"history": (t.history(spark, sf), F.col("row_seq") % 2)}
    return _in_two_runs(spark, "incremental-spanning", frames, run)


def incremental_spanning(spark, sf):
    """Verdicts of tickets whose records arrive in two runs."""
    return maintained.read_maintained(spark, f"{_spanning(spark, sf)}/tables", "verdicts")


def incremental_spanning_detail(spark, sf):
    """The detail of tickets whose records arrive in two runs."""
    return maintained.read_maintained(spark, f"{_spanning(spark, sf)}/tables", "detail")


def incremental_both_new(spark, sf):
    """Second job over two runs with new rows on both sides."""
    by_ticket = F.col("id_ticket").cast("bigint") % 2
    frames = {
        "description": (t.order_description(spark, sf), by_ticket),
        "verdicts": (t.order_verdicts(spark, sf), by_ticket),
    }

    def run(streams, folder):
        incremental.append_tickets(
            spark, streams["description"], streams["verdicts"], f"{folder}/checkpoint",
            f"{folder}/parked", f"{folder}/tickets",
        )

    folder = _in_two_runs(spark, "incremental-tickets", frames, run)
    numbers = ("diferencia_tiempo_festivos", "Diferencia_tiempo_dias")
    listed = incremental.read_runs(spark, f"{folder}/tickets")
    return listed.withColumns({n: number_or_null(n) for n in numbers})


def incremental_indicators(spark, sf):
    """Third job over two runs; the tickets of a project land together."""
    categories = _categories(spark, sf)
    frames = {"tickets": (_tickets(spark, sf), F.crc32("proyecto") % 2)}

    def run(streams, folder):
        incremental.append_indicators(
            streams["tickets"], categories, f"{folder}/checkpoint", f"{folder}/indicators"
        )

    folder = _in_two_runs(spark, "incremental-indicators", frames, run)
    return incremental.read_appended(spark, f"{folder}/indicators")


def incremental_landing(spark, sf):
    """Fourth job over two runs; one table has no rows in the second."""
    frames = {
        name: (df, F.lit(0) if name == "lnd_nations" else F.crc32("nombre") % 2)
        for name, df in t.landing_tables(spark, sf).items()
    }

    def run(streams, folder):
        incremental.append_landing(
            spark, streams, f"{folder}/checkpoint", f"{folder}/parked", f"{folder}/standard"
        )

    folder = _in_two_runs(spark, "incremental-landing", frames, run)
    return incremental.read_runs(spark, f"{folder}/standard")


def incremental_primary(spark, sf):
    """Fifth job over two runs; the rows of a key land together."""
    by_id = F.crc32("id") % 2
    standard, _ = landing.standardise(t.landing_tables(spark, sf))
    frames = {"standard": (standard, by_id), "indicators": (indicators_all(spark, sf), by_id)}

    def run(streams, folder):
        incremental.append_primary(
            spark, streams["standard"], streams["indicators"], f"{folder}/checkpoint",
            f"{folder}/parked", f"{folder}/primary",
        )

    folder = _in_two_runs(spark, "incremental-primary", frames, run)
    return incremental.read_runs(spark, f"{folder}/primary")


def incremental_output(spark, sf):
    """Sixth job over two runs; the rows of a key land together."""
    by_id = F.crc32("id") % 2
    frames = {"primary": (t.landed(spark, sf), by_id), "claims": (t.claims(spark, sf), by_id)}

    def run(streams, folder):
        incremental.append_output(
            spark, streams["primary"], streams["claims"], f"{folder}/checkpoint",
            f"{folder}/parked", f"{folder}/output",
        )

    folder = _in_two_runs(spark, "incremental-output", frames, run)
    return incremental.read_runs(spark, f"{folder}/output")


QUERIES = {
    f.__name__: f
    for f in (
        mixed_timestamp_parse,
        holiday_year_pin,
        next_state,
        next_state_file_order,
        next_state_sparse,
        next_state_hot,
        state_durations,
        working_states,
        nonbusiness_days,
        nonbusiness_days_calendar,
        state_detail,
        state_detail_file_order,
        state_detail_numbered,
        closing_date,
        ticket_sla,
        verdict_table,
        regroup_identity,
        earliest_partition,
        ticket_list,
        tickets_without_month,
        month_bucket,
        synonym_repair,
        cell_replacement,
        cell_replacement_by_table,
        label_split,
        flow_membership,
        rollup_all_requests,
        rollup_by_request,
        rollup_parameterised,
        fill_zero_option,
        sums_any_size,
        composite_key_join,
        indicator_q,
        indicator_ans,
        indicator_kpi,
        indicators_all,
        indicator_totals_ans,
        indicator_totals_kpi,
        landing_union,
        empty_landing,
        distinct_landed,
        decimal_comma,
        decimal_comma_plain,
        nan_text_zero,
        primary_output,
        override_output,
        passthrough_output,
        claimed_keys,
        union_of_claims,
        service_report,
        input_counts,
        state_job,
        state_job_detail,
        staged_visits,
        incremental_append,
        incremental_spanning,
        incremental_spanning_detail,
        incremental_static_join,
        incremental_states,
        incremental_states_detail,
        incremental_both_new,
        incremental_indicators,
        incremental_landing,
        incremental_primary,
        incremental_output,
    )
}
