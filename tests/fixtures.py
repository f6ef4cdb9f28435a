"""Hand-worked rows shared by the tests."""

from deskpulse import schemas

HISTORY = [
    ("T1", "Crear ticket", "01/06/2020 08:00:00 +00:00", "20200630", 1),
    ("T1", "En gestión", "02/06/2020 09:00:00 +00:00", "20200630", 2),
    ("T1", "En Validación", "06/05/2020 09:00:00 AM +00:00", "20200630", 3),
    ("T1", "Cerrado", "08/06/2020 09:00:00 +00:00", "20200630", 4),
    ("T2", "Crear Ticket", "01/06/2020 10:00:00 +00:00", "20200630", 5),
    ("T2", "En gestión", "01/06/2020 12:00:00 +00:00", "20200630", 6),
    ("T2", "Cerrado", "15/06/2020 12:00:00 +00:00", "20200630", 7),
]

HOLIDAYS = [("10/06/2019",)]


def history(spark, rows=HISTORY):
    return spark.createDataFrame(rows, schemas.HISTORY)


def holidays(spark, rows=HOLIDAYS):
    return spark.createDataFrame(rows, schemas.HOLIDAYS)


def description(spark):
    return spark.createDataFrame(
        [
            ("T1", "P", "F1", "A", 0.0, 0.0, None, "x"),
            ("T2", "P", "F1", "B", 4.0, -1.0, "ana", "x"),
        ],
        schemas.DESCRIPTION,
    )


def categories(spark, rows):
    """rows: (id_indicador, type, flow, request, key); other columns fixed."""
    return spark.createDataFrame(
        [(i, t, f"name {i}", "P", "G", f, r, "file", "x", k) for i, t, f, r, k in rows],
        "c0 string, c1 string, c2 string, c3 string, c4 string, c5 string, c6 string, "
        "c7 string, col8 string, c9 string",
    )


CATEGORIES = [
    ("I1", "Q", "F1", "Todas", "P_F1_Todas"),
    ("I2", "ANS", "F1", "Todas", "P_F1_Todas"),
    ("I3", "KPI", "F1", "Todas", "P_F1_Todas"),
    ("I4", "Q", "F1", "B", "P_F1_B"),
]


def standard(spark, rows):
    """rows: (id, fecha, process, valor)."""
    return spark.createDataFrame(
        [(0, i, "n", f, v, "", "", "", "", p, "", 1, "d") for i, f, p, v in rows],
        schemas.STANDARD,
    )
