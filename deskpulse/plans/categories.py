"""The category table that says which indicators exist and what feeds them."""

from pyspark.sql import functions as F

from deskpulse.functions.text import lowered
from deskpulse.functions.values import covers_all_requests
from deskpulse.operators.columns import rename_all, replace_cells
from deskpulse.schemas import CATEGORIES, KEY_REPAIRS, NAME_REPAIRS


def repaired_categories(raw, mappings=(NAME_REPAIRS, KEY_REPAIRS)):
    """Named columns, repaired spellings and a lower-case key.

    ``mappings`` are applied one after the other; see ``replace_cells``.
    """
    named = rename_all(raw.drop("col8"), CATEGORIES.fieldNames())
    repaired = replace_cells(named, *mappings)
    return repaired.withColumn("id_pro_flu_sol", lowered("id_pro_flu_sol"))


def of_type(categories, kind):
    return categories.filter(F.col("tipo_indicador") == kind)


def flows_by_branch(categories):
    """Distinct (tipo_indicador, all_requests, flujo): the flows each rollup is kept for."""
    return (
        categories.withColumn("all_requests", covers_all_requests("tipo_solicitud"))
        .filter("all_requests IS NOT NULL AND flujo IS NOT NULL")
        .select("tipo_indicador", "all_requests", "flujo")
        .distinct()
    )
