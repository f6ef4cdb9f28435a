"""The job inputs, taken from the given tables. Every input uses all rows."""

from pyspark.sql import functions as F

from deskpulse.functions.text import with_float_texts
from deskpulse.operators.combine import union_all
from deskpulse.schemas import ALL_REQUESTS, INDICATOR_TYPES, KEY_REPAIRS, NAME_REPAIRS, STANDARD

EVENT_YEARS = (2024,)
ORDER_YEARS = tuple(range(1995, 2003))
IN_24H = "dd/MM/yyyy HH:mm:ss' +00:00'"
IN_12H = "MM/dd/yyyy hh:mm:ss a' +00:00'"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def two_spellings(time, parity):
    """A ticket time, in the 24-hour spelling for even numbers, else the 12-hour one."""
    return F.when(F.col(parity) % 2 == 0, F.date_format(time, IN_24H)).otherwise(
        F.date_format(time, IN_12H)
    )


def history_of(events, row_seq=None, *more):
    """User actions as the state history of one ticket per user, one export per week."""
    row_seq = F.col("event_id") if row_seq is None else row_seq
    kind = F.col("event_type")
    time = F.col("ts").cast("timestamp")
    return events.select(
        F.col("user_id").cast("string").alias("id_ticket"),
        F.when(kind == "signup", "Crear ticket")
        .when(kind == "view", "En gestión")
        .when(kind == "click", "En Validación")
        .when(kind != "error", kind)  # an error leaves the state empty
        .alias("estado"),
        two_spellings(time, "event_id").alias("fecha"),
        F.date_format(F.date_trunc("week", time), "yyyyMMdd").alias("date"),
        row_seq.alias("row_seq"),
        *more,
    )


def history(spark, sf_dir):
    return history_of(table(spark, sf_dir, "events"))


def holidays(spark, sf_dir):
    """The Mondays of January 2024, spelled with another year."""
    day = F.lpad((F.col("r_regionkey") * 7 + 1).cast("string"), 2, "0")
    return table(spark, sf_dir, "region").select(F.concat(day, F.lit("/01/2019")).alias("date"))


def _order_flows(spark, sf_dir):
    """Orders with project, flow and request type; some requests missing or 'Todas'."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    key = F.col("o_orderkey")
    request = (
        F.when(key % 51 == 0, None).when(key % 50 == 0, ALL_REQUESTS).otherwise(F.col("o_orderstatus"))
    )
    return table(spark, sf_dir, "orders").join(customers, "o_custkey").withColumns(
        {
            "proyecto": F.col("c_mktsegment"),
            "flujo": F.col("o_orderpriority"),
            "tipo_solicitud": request,
        }
    )


def order_description(spark, sf_dir):
    """One ticket per order, exported twice, with unset volumes and missing cells."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("lines"),
            F.count_if(F.col("l_returnflag") == "A").cast("double").alias("returned"),
        )
    )
    key = F.col("o_orderkey")
    return (
        _order_flows(spark, sf_dir)
        .join(lines, "o_orderkey", "left")
        .select(
            key.cast("string").alias("id_ticket"),
            "proyecto",
            "flujo",
            "tipo_solicitud",
            F.col("c_nationkey").cast("string").alias("pais"),
            F.col("o_totalprice").alias("importe"),
            F.when(key % 37 == 0, float("nan"))
            .when(key % 40 == 0, -1.0)
            .otherwise(F.col("lines"))
            .alias("volumen_total_casos"),
            F.when(key % 30 == 0, -1.0).otherwise(F.col("returned")).alias("total_casos_ok"),
            F.explode(F.array(F.col("c_name"), F.lit(None).cast("string"))).alias("user_name"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
        )
    )


def order_categories(spark, sf_dir):
    return categories_of(_order_flows(spark, sf_dir))


def order_verdicts(spark, sf_dir):
    """A published verdict per order: its price in seconds, closed on the order date."""
    seconds = F.col("o_totalprice").cast("double")
    days = seconds / F.lit(86400.0)
    verdicts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id_ticket"),
        F.when(F.col("o_orderkey") % 97 == 0, "0")
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
        .alias("date"),
        seconds.alias("Diferencia_tiempo"),
        F.lit("0.0").alias("dias_festivos"),
        days.alias("diferencia_tiempo_festivos"),
        days.alias("Diferencia_tiempo_dias"),
        F.when(days >= 5.0, "KO").otherwise("OK").alias("ok_ko"),
    )
    return with_float_texts(verdicts, "diferencia_tiempo_festivos", "Diferencia_tiempo_dias")


def customer_description(spark, sf_dir):
    """One ticket per customer; matches the tickets of the event history."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id_ticket"),
        F.col("c_mktsegment").alias("proyecto"),
        F.concat(F.lit("Flujo "), (nation % 4).cast("string")).alias("flujo"),
        F.when(nation % 3 == 0, "O").when(nation % 3 == 1, "F").otherwise("P").alias("tipo_solicitud"),
        (key % 4).cast("double").alias("volumen_total_casos"),
        F.lit(-1.0).alias("total_casos_ok"),
        F.col("c_name").alias("user_name"),
        F.lit("20240131").alias("date"),
    )


def categories_of(description):
    """Raw categories for the flows of a description, from all its rows.

    Every project and flow gets a category over all requests per type, and every request
    type, a missing one too, one of its own type. That (ANS, 5-LOW) and (KPI, Flujo 0)
    have no category over all requests is what the flow lists are tested with.
    """
    seen = description.select(
        "proyecto", "flujo", F.coalesce("tipo_solicitud", F.lit("Sin tipo")).alias("tipo_solicitud")
    ).distinct()
    request, flow = F.col("tipo_solicitud"), F.col("flujo")
    own_kind = F.when(request == "O", "Q").when(request == "F", "ANS").otherwise("KPI")
    wanted = F.explode(
        F.array(
            *[F.struct(F.lit(k).alias("kind"), F.lit(ALL_REQUESTS).alias("request")) for k in INDICATOR_TYPES],
            F.struct(own_kind.alias("kind"), request.alias("request")),
        )
    )
    left_out = "request = 'Todas' AND (kind, flujo) IN (('ANS', '5-LOW'), ('KPI', 'Flujo 0'))"
    rows = (
        seen.select("proyecto", flow, wanted.alias("wanted"))
        .select("proyecto", "flujo", "wanted.*")
        .filter(f"NOT ({left_out})")
        .distinct()
    )
    return rows.select(
        F.concat_ws("-", "kind", "proyecto", "flujo").alias("col0"),
        F.col("kind").alias("col1"),
        F.concat(F.lit("Indicador "), F.col("kind")).alias("col2"),
        F.col("proyecto").alias("col3"),
        F.col("proyecto").alias("col4"),
        F.col("flujo").alias("col5"),
        F.col("request").alias("col6"),
        F.lit("fichero").alias("col7"),
        F.lit("sin uso").alias("col8"),
        F.concat_ws("_", "proyecto", "flujo", "request").alias("col9"),
    )


def misspelled_categories(spark, sf_dir):
    """One raw category per part, each with one of the spellings to be repaired."""
    names = F.array(*[F.lit(n) for n in (*NAME_REPAIRS, "Nombre correcto")])
    keys = F.array(*[F.lit(k) for k in (*KEY_REPAIRS, "Proyecto_Flujo_Todas")])
    part = F.col("p_partkey")
    name = F.get(names, (part % 6).cast("int"))
    return table(spark, sf_dir, "part").select(
        part.cast("string").alias("col0"),
        F.lit("Q").alias("col1"),
        F.col("p_name").alias("col2"),
        F.col("p_brand").alias("col3"),
        F.col("p_type").alias("col4"),
        name.alias("col5"),
        F.when(part % 2 == 0, ALL_REQUESTS).otherwise(name).alias("col6"),
        F.lit("fichero").alias("col7"),
        F.lit("sin uso").alias("col8"),
        F.get(keys, (part % 10).cast("int")).alias("col9"),
    )


def _standard_rows(df, id_, name, value, process, month):
    blank = F.lit("")
    columns = [
        F.lit(1).cast("bigint"),
        id_,
        name,
        F.concat(F.lit("01/"), F.lpad(month.cast("string"), 2, "0"), F.lit("/2024")),
        value,
        blank,
        blank,
        blank,
        blank,
        process,
        blank,
        month.cast("bigint"),
        F.lit("externo"),
    ]
    return df.select(*[c.alias(n) for c, n in zip(columns, STANDARD.fieldNames())])


def landing_tables(spark, sf_dir):
    """Six landed tables of 13 columns and one that is a column short.

    Parts are landed twice in the same way, so rows repeat.
    """
    part = table(spark, sf_dir, "part")
    month = F.col("p_size") % 12 + 1

    def parts(name):
        return _standard_rows(
            part, name, F.col("p_name"), F.col("p_size").cast("string"), F.col("p_type"), month
        )

    supplier, customer, nation = (table(spark, sf_dir, t) for t in ("supplier", "customer", "nation"))
    return {
        "lnd_parts": parts(F.concat_ws("-", "p_brand", "p_type")),
        "lnd_parts_again": parts(F.concat_ws("-", "p_brand", "p_type")),
        "lnd_brands": parts(F.col("p_brand")),
        "lnd_suppliers": _standard_rows(
            supplier, F.col("s_name"), F.lit("proveedor"), F.col("s_nationkey").cast("string"),
            F.lit("compras"), F.col("s_nationkey") % 12 + 1,
        ),
        "lnd_customers": _standard_rows(
            customer, F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string"),
            F.lit("ventas"), F.col("c_nationkey") % 12 + 1,
        ),
        "lnd_nations": _standard_rows(
            nation, F.col("n_name"), F.lit("nación"), F.col("n_regionkey").cast("string"),
            F.lit("países"), F.col("n_nationkey") % 12 + 1,
        ),
        "lnd_narrow": _standard_rows(
            nation, F.col("n_name"), F.lit("estrecha"), F.col("n_regionkey").cast("string"),
            F.lit("países"), F.col("n_nationkey") % 12 + 1,
        ).drop("descripción"),
    }


def landed(spark, sf_dir):
    return union_all([df for df in list(landing_tables(spark, sf_dir).values())[:6]])


def claims(spark, sf_dir):
    """Claims on the keys of economy parts; a new key for every other part and customer."""
    part = table(spark, sf_dir, "part")
    claimed = F.concat_ws("-", "p_brand", "p_type")
    on_parts = _standard_rows(
        part,
        F.when(F.col("p_type") == "ECONOMY", claimed).otherwise(F.concat(F.lit("nuevo "), "p_name")),
        F.lit("alegación"),
        F.lit("1,9"),
        F.col("p_type"),
        F.col("p_size") % 12 + 1,
    )
    new = _standard_rows(
        table(spark, sf_dir, "customer"), F.concat(F.lit("nuevo "), F.col("c_name")),
        F.lit("alegación"), F.lit("2,5"), F.lit("ventas"), F.col("c_nationkey") % 12 + 1,
    )
    return on_parts.unionByName(new)
