"""The next row in an order, without putting one long run of rows in one task.

``lead`` sorts a whole window partition in a single task. Rows here are cut into
slices that follow the order. ``lead`` runs inside each slice, and the last row of
a slice takes the first row of the following slice from a small table of slice
heads. Where the cuts fall changes only the work per task, never the result.

Both functions append ``has_next`` and ``next_<column>`` for each wanted column.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

SPLIT_ROWS = 1_000_000
MOST_HOT_GROUPS = 100_000


def _lead_inside(rows, keys, order, values):
    """One ``lead`` per column, so that unused ones are dropped before the shuffle."""
    inside = Window.partitionBy(*keys).orderBy(*order)
    leads = {f"next_{v}": F.lead(v).over(inside) for v in values}
    return rows.withColumns({"has_next": F.lead(F.lit(True)).over(inside), **leads})


def _lead_over_slices(rows, split_rows, group, order, values):
    """``split_rows`` are those of the rows whose group has more than one slice."""
    keys = [*group, "_slice"]
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    # values of any type are aggregated by sorting, so only a slice's earliest rows go there
    earliest = split_rows.groupBy(*keys).agg(F.min(order[0]).alias("_earliest"))
    first_rows = split_rows.join(F.broadcast(earliest), keys).filter(
        F.col(order[0]).eqNullSafe(F.col("_earliest"))
    )
    heads = first_rows.groupBy(*keys).agg(
        F.min(at).alias("_at"), F.min_by(F.struct(*values), at).alias("_head")
    )
    across = Window.partitionBy(*group).orderBy("_at") if group else Window.orderBy("_at")
    following = heads.select(*keys, F.lead("_head").over(across).alias("_over"))
    joined = _lead_inside(rows, keys, order, values).join(following, keys, "left")
    known = F.col("has_next").isNotNull()
    return joined.withColumns(
        {
            "has_next": known | F.col("_over").isNotNull(),
            **{
                f"next_{v}": F.when(known, F.col(f"next_{v}")).otherwise(F.col("_over")[v])
                for v in values
            },
        }
    ).drop("_over")


def _width(low, high, count, limit):
    """Width of equal parts of a range of whole numbers, about ``limit`` rows in each."""
    parts = F.ceil(count / limit)
    return F.greatest(F.lit(1), F.ceil((high - low + 1) / parts)).cast("bigint")


def _part(value, low, width):
    return F.floor((value - low) / width)


def next_in_sequence(rows, sequence, values, chunk_rows=SPLIT_ROWS):
    """The next row of the whole table.

    ``sequence`` is a distinct whole number per row; it may have gaps of any size.
    """
    sliced = sequence_slices(rows, sequence, chunk_rows)
    return _lead_over_slices(sliced, sliced, [], [sequence], values).drop("_slice")


def sequence_slices(rows, sequence, chunk_rows=SPLIT_ROWS):
    """Append ``_slice``, which follows the order of a whole number.

    The range of numbers is cut into equal parts, as many as the rows need, and a part
    that still holds many rows once more by its own range. So the slices, and the head
    rows that meet in one window, number about rows / chunk_rows with gaps of any size.
    """
    at = F.col(sequence)
    whole = rows.agg(
        F.min(at).alias("low"),
        F.max(at).alias("high"),
        F.greatest(F.lit(chunk_rows), F.count(at) / F.lit(MOST_HOT_GROUPS)).alias("limit"),
        F.count(at).alias("count"),
    )
    cut = whole.select(
        F.struct("low", "limit", _width(F.col("low"), F.col("high"), F.col("count"), F.col("limit")).alias("width"))
    ).scalar()
    parted = rows.withColumn("_part", _part(at, cut["low"], cut["width"]))
    limit = F.col("count") > 2 * cut["limit"]
    full = parted.groupBy("_part").agg(
        F.min(at).alias("_low"), F.max(at).alias("_high"), F.count(at).alias("count")
    )
    full = full.filter(limit).select(
        "_part",
        "_low",
        _width(F.col("_low"), F.col("_high"), F.col("count"), cut["limit"]).alias("_width"),
    )
    # at most half of MOST_HOT_GROUPS parts can be that full
    chunked = parted.join(F.broadcast(full), "_part", "left").withColumn(
        "_slice", F.struct("_part", _part(at, F.col("_low"), F.col("_width")).alias("sub"))
    )
    return chunked.drop("_part", "_low", "_width")


def _hot_limit(counts, split_rows):
    """Rows above which a key is hot: split_rows, or a MOST_HOT_GROUPS-th of all rows.

    There can never be more than MOST_HOT_GROUPS keys above it, so a list of hot keys
    is safe to broadcast.
    """
    share = counts.select(F.sum("count") / F.lit(MOST_HOT_GROUPS)).scalar()
    return F.greatest(F.lit(float(split_rows)), share)


def next_in_group(
    rows, group, time, sequence, values, split_rows=SPLIT_ROWS, prepare=lambda rows: rows
):
    """The next row, by (time, sequence), of the same group.

    Groups of normal size stay whole. A group above ``split_rows`` is cut by hour, an hour
    of it that is still above into equal spans of time, and a span that is still above by
    second and, by the range of its numbers, into equal parts of ``sequence``. Each cut
    makes as many slices as the rows need, so heads stay few when numbers are sparse.
    ``split_rows=None`` saves the counting for logs known to have no such group.
    ``prepare`` may append columns such as ``time``; groups are counted and hot rows
    are picked without them.

    The group columns travel once, as the struct ``_group``. Together with ``_slice``
    it stays in the result: the rows leave this step partitioned by the two.
    """
    columns = prepare(rows).columns
    hour = F.floor(F.unix_seconds(time) / F.lit(3600))
    rows = rows.withColumn("_group", F.struct(*group)).drop(*group)
    whole = [F.col("_group")[c].alias(c) if c in group else F.col(c) for c in columns]
    added = ["has_next", *[f"next_{v}" for v in values]]

    if split_rows is None:
        alone = prepare(rows).withColumn("_slice", F.lit(0))
        led = _lead_inside(alone, ["_group", "_slice"], [time, sequence], values).withColumn(
            "has_next", F.col("has_next").isNotNull()
        )
        return led.select(*whole, *added, "_group", "_slice")

    second = F.unix_seconds(time)
    span = F.floor(second % 3600 / F.col("_span_width"))

    def in_spans(some):
        by_hour = some.withColumn("_hour", hour).join(
            F.broadcast(full_hours), ["_group", "_hour"], "left"
        )
        return by_hour.withColumn("_span", span).drop("_span_width")

    def sliced(some):
        by_span = in_spans(some).join(
            F.broadcast(full_spans), ["_group", "_hour", "_span"], "left"
        )
        run = _part(F.col(sequence), F.col("_low"), F.col("_width"))
        cut = F.struct(
            "_hour", "_span", F.when(run.isNotNull(), second).alias("second"), run.alias("run")
        )
        return by_span.withColumn("_slice", cut).drop("_hour", "_span", "_low", "_width")

    counts = rows.groupBy("_group").count()
    limit = _hot_limit(counts, split_rows)
    hot = counts.filter(F.col("count") > limit).select("_group")
    hot_rows = prepare(rows.join(F.broadcast(hot), "_group", "left_semi"))
    hours = hot_rows.groupBy("_group", hour.alias("_hour")).count()
    full_hours = hours.filter(F.col("count") > limit).select(
        "_group", "_hour", F.ceil(F.lit(3600) / F.ceil(F.col("count") / limit)).alias("_span_width")
    )
    spans = (
        in_spans(hot_rows)
        .filter("_span IS NOT NULL")
        .groupBy("_group", "_hour", "_span")
        .agg(
            F.min(sequence).alias("_low"),
            F.max(sequence).alias("_high"),
            F.count(F.lit(1)).alias("count"),
        )
    )
    full_spans = spans.filter(F.col("count") > 2 * limit).select(
        "_group",
        "_hour",
        "_span",
        "_low",
        _width(F.col("_low"), F.col("_high"), F.col("count"), limit).alias("_width"),
    )

    flagged = rows.join(F.broadcast(hot.withColumn("_is_hot", F.lit(True))), "_group", "left")
    cut_rows = sliced(prepare(flagged)).withColumn(
        "_slice", F.when(F.col("_is_hot"), F.col("_slice"))
    ).drop("_is_hot")
    led = _lead_over_slices(cut_rows, sliced(hot_rows), ["_group"], [time, sequence], values)
    return led.select(*whole, *added, "_group", "_slice")
