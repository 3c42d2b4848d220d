"""One-step page conversion along a flow of pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmark.functions import ratio
from trailmark.operators.skew import hot_keys

HOT_SESSION_ROWS = 5_000_000


def _literal(spark: SparkSession, rows: Sequence[Sequence[int | None]], *names: str) -> DataFrame:
    """A few rows of long values given as parameters."""
    values = [
        F.struct(*[F.lit(v).cast("long").alias(name) for v, name in zip(row, names)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*values)))


def flow_steps(spark: SparkSession, flow: Sequence[int]) -> DataFrame:
    """step, from_page, to_page: one row for each step of the flow; step 0 is the start page."""
    pages = [None, *[int(p) for p in flow]]
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(pages, pages[1:]))]
    return _literal(spark, rows, "step", "from_page", "to_page")


def _flow_pairs(spark: SparkSession, flow: Sequence[int]) -> DataFrame:
    """The distinct (from, to) pairs of the flow. As small as the parameter, hence broadcast."""
    pairs = sorted({(int(a), int(b)) for a, b in zip(flow, flow[1:])})
    return F.broadcast(_literal(spark, pairs, "_from", "_to"))


def _flow_rows(moves: DataFrame, flow: Sequence[int], *keep: str) -> DataFrame:
    """Moves (prev_page, page_id) that are a pair of the flow (others lose their prev_page), views of the
    start page, and rows marked by one of the `keep` columns."""
    pairs = _flow_pairs(moves.sparkSession, flow)
    matched = moves.join(
        pairs, (F.col("prev_page") == F.col("_from")) & (F.col("page_id") == F.col("_to")), "left"
    )
    wanted = F.col("_from").isNotNull() | (F.col("page_id") == int(flow[0]))
    for mark in keep:
        wanted = wanted | F.col(mark)
    return matched.where(wanted).withColumn("prev_page", F.col("_from")).drop("_from", "_to")


def _usual_moves(rows: DataFrame, order: Sequence[str], flow: Sequence[int]) -> DataFrame:
    by_time = Window.partitionBy("session_id").orderBy(*order)
    moves = rows.select("page_id", F.lag("page_id").over(by_time).alias("prev_page"))
    return _flow_rows(moves, flow).groupBy("prev_page", "page_id").agg(F.count(F.lit(1)).alias("n"))


def _hot_moves(rows: DataFrame, order: Sequence[str], flow: Sequence[int]) -> DataFrame:
    """As `_usual_moves` for sessions too large for one task. Rows that nothing tells apart are combined into one
    with their number, as no cut could part them: all but the first move from the page to itself. Each session is
    cut along its time order into the ranges of a range partitioning, moves are counted inside each range, and the
    move into the first row of a range is found from the last row of the range before, over a few rows per range."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    combined = rows.groupBy("session_id", *order).agg(F.count(F.lit(1)).alias("_copies"))
    ranged = combined.repartitionByRange(ranges, "session_id", *order).withColumn(
        "_range", F.spark_partition_id()
    )
    in_range = Window.partitionBy("session_id", "_range").orderBy(*order)
    placed = ranged.select(
        "session_id",
        "_range",
        "page_id",
        "_copies",
        F.lag("page_id").over(in_range).alias("prev_page"),
        F.lag(F.lit(1)).over(in_range).isNull().alias("_head"),
        F.lead(F.lit(1)).over(in_range).isNull().alias("_tail"),
    )
    once = F.struct("prev_page", "_head", "_tail", F.lit(1).cast("long").alias("n"))
    again = F.struct(
        F.col("page_id").alias("prev_page"),
        F.lit(False).alias("_head"),
        F.lit(False).alias("_tail"),
        (F.col("_copies") - 1).alias("n"),
    )
    moves = placed.select(
        "session_id",
        "_range",
        "page_id",
        F.inline(F.when(F.col("_copies") > 1, F.array(once, again)).otherwise(F.array(once))),
    )
    counted = (
        _flow_rows(moves, flow, "_head", "_tail")
        .groupBy("session_id", "_range", "_head", "_tail", "prev_page", "page_id")
        .agg(F.sum("n").alias("n"))
    )
    before = (
        Window.partitionBy("session_id")
        .orderBy("_range", F.col("_head").desc(), "_tail")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    last_page = F.last(F.when(F.col("_tail"), F.struct("page_id")), ignorenulls=True).over(before)
    stitched = counted.select(
        "page_id",
        F.when(F.col("_head"), last_page["page_id"]).otherwise(F.col("prev_page")).alias("prev_page"),
        "n",
    )
    return _flow_rows(stitched, flow).groupBy("prev_page", "page_id").agg(F.sum("n").alias("n"))


def _moves(
    actions: DataFrame, flow: Sequence[int], tie_breakers: Sequence[str], hot_rows: int | None
) -> DataFrame:
    """(prev_page, page_id, n) for the pairs of the flow, and prev_page NULL for other views of its start."""
    if len(flow) < 2:
        raise ValueError("a page flow needs at least two pages")
    order = list(dict.fromkeys(["action_time", *tie_breakers, "page_id"]))
    rows = actions.select("session_id", *order)
    if hot_rows is None:
        return _usual_moves(rows, order, flow)
    # at most one session for every `hot_rows` rows
    hot = F.broadcast(hot_keys(rows, ["session_id"], hot_rows)).alias("hot")
    is_hot = F.col("rows.session_id").eqNullSafe(F.col("hot.session_id"))  # missing ids are one session
    usual = _usual_moves(rows.alias("rows").join(hot, is_hot, "left_anti"), order, flow)
    large = _hot_moves(rows.alias("rows").join(hot, is_hot, "left_semi"), order, flow)
    return usual.unionByName(large).groupBy("prev_page", "page_id").agg(F.sum("n").alias("n"))


def page_pair_counts(
    actions: DataFrame,
    flow: Sequence[int],
    tie_breakers: Sequence[str] = (),
    hot_rows: int | None = HOT_SESSION_ROWS,
) -> DataFrame:
    """How often each (from, to) pair of the flow occurs as two consecutive views of a session.

    Views of the same second are ordered by `tie_breakers`, then by page. Sessions of `hot_rows` rows or more are spread
    over several tasks; None leaves that search out.
    """
    moves = _moves(actions, flow, tie_breakers, hot_rows).where(F.col("prev_page").isNotNull())
    return moves.select(
        F.col("prev_page").alias("from_page"), F.col("page_id").alias("to_page"), F.col("n").alias("pair_count")
    )


def page_conversion(
    actions: DataFrame,
    flow: Sequence[int],
    tie_breakers: Sequence[str] = (),
    hot_rows: int | None = HOT_SESSION_ROWS,
) -> DataFrame:
    """step, from_page, to_page, pair_count, convert_rate: each step's count over the count of the step
    before, the first over the views of the start page; two decimals, NULL after a step nobody took.

    All counts come from one pass; only rows as many as the flow has steps reach the final window.
    """
    moves = _moves(actions, flow, tie_breakers, hot_rows)
    # a move counts for its pair, and for the start page if it leads there
    pair = F.struct(F.col("prev_page").alias("from_page"), F.col("page_id").alias("to_page"))
    start = F.struct(F.lit(None).cast("long").alias("from_page"), F.col("page_id").alias("to_page"))
    counted_for = F.array_compact(
        F.array(
            F.when(F.col("prev_page").isNotNull(), pair), F.when(F.col("page_id") == int(flow[0]), start)
        )
    )
    totals = (
        moves.select(F.inline(counted_for), "n")
        .groupBy("from_page", "to_page")
        .agg(F.sum("n").alias("pair_count"))
    )
    same_pair = F.col("s.from_page").eqNullSafe(F.col("t.from_page")) & (
        F.col("s.to_page") == F.col("t.to_page")
    )
    steps = flow_steps(actions.sparkSession, flow).alias("s").join(totals.alias("t"), same_pair, "left")
    counts = steps.select("s.*", F.coalesce("t.pair_count", F.lit(0)).alias("pair_count"))
    base = F.lag("pair_count").over(Window.orderBy("step"))
    return counts.withColumn("convert_rate", ratio(F.col("pair_count"), base)).where("step > 0")


def conversion_text(conversion: DataFrame) -> DataFrame:
    """One row with the rates as text, in the order of the flow: `1_2=0.5|2_3=0.25`.

    As many rows as the flow has steps are put together. A NULL rate is written as `null`.
    """
    rate = F.coalesce(F.col("convert_rate").cast("string"), F.lit("null"))
    part = F.concat("from_page", F.lit("_"), "to_page", F.lit("="), rate)
    parts = F.array_sort(F.collect_list(F.struct("step", part.alias("text"))))
    return conversion.agg(F.array_join(F.transform(parts, lambda p: p["text"]), "|").alias("convert_rate"))
