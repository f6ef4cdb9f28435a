"""Tables landed by other systems -> one standard indicator table."""

from deskpulse.operators.columns import as_text, conform
from deskpulse.operators.combine import fitting, union_all
from deskpulse.schemas import PUBLISHED, STANDARD_COLUMNS


def standardise(tables):
    """Distinct rows of all tables with 13 columns, by position.

    ``tables`` maps names to frames. Returns the standard table and a report frame
    (table_name, columns, taken) that names the tables left out for their width.
    """
    taken, report = fitting(tables, len(STANDARD_COLUMNS))
    spark = next(iter(tables.values())).sparkSession
    report = spark.createDataFrame(report, "table_name string, columns int, taken boolean")
    if not taken:
        return spark.createDataFrame([], PUBLISHED), report
    frames = [as_text(df.toDF(*STANDARD_COLUMNS), "calibración") for df in taken.values()]
    return union_all([conform(df, PUBLISHED) for df in frames]).distinct(), report
