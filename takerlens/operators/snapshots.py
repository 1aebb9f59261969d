"""Market snapshots: newest state, prior state and change-only appends."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from takerlens.functions.values import hours, seconds_between
from takerlens.operators.asof import asof_join
from takerlens.operators.filters import not_closed
from takerlens.operators.merge import last_wins
from takerlens.session import staged

KEY = ["ticker", "run_ts"]


def newest(rows: DataFrame, column: str) -> Column:
    """The largest value of a column as a scalar subquery."""
    return rows.select(F.max(column)).scalar()


def latest_snapshot(snapshots: DataFrame, as_of=None, window_hours: float = 24,
                    order: Sequence[str] = ("run_ts",)) -> DataFrame:
    """Newest row per market among recent rows that are not closed.

    Closed rows go before the pick, so an older open row can stand in for them.
    `as_of` defaults to the newest run, which keeps results repeatable.
    """
    moment = newest(snapshots, "run_ts") if as_of is None else F.lit(as_of)
    recent = snapshots.where((F.col("run_ts") > moment - hours(window_hours)) & not_closed())
    return last_wins(recent, ["ticker"], order)


def prior_state(snapshots: DataFrame, window_hours: float, order: Sequence[str],
                columns: Sequence[str]) -> DataFrame:
    """Backward as-of lookup: the previous row of the market within the window.

    Adds `prior_<column>` and `prior_run_ts` (NULL when nothing is near enough).
    Rows are first made unique per (ticker, run), so a market's partition is
    bounded by the number of runs, whatever the number of copies.
    """
    unique = last_wins(snapshots, KEY, order)
    w = Window.partitionBy("ticker").orderBy("run_ts")
    prior = F.lag(F.struct("run_ts", *[c for c in columns if c != "run_ts"])).over(w)
    near = F.col("_prior.run_ts") > F.col("run_ts") - hours(window_hours)
    out = unique.withColumn("_prior", prior).withColumn("_prior", F.when(near, F.col("_prior")))
    picked = [F.col(f"_prior.{c}").alias(f"prior_{c}") for c in dict.fromkeys(["run_ts", *columns])]
    return out.select(*snapshots.columns, *picked)


def stored_state(incoming: DataFrame, stored: DataFrame, window_hours: float, columns: Sequence[str],
                 order: Sequence[str] = (), buckets: int = 1) -> DataFrame:
    """The as-of lookup against another table: `prior_<column>` of the newest stored run within the window."""
    return asof_join(incoming, stored, ["ticker"], "run_ts", "run_ts", timedelta(hours=window_hours), columns, order=order,
                     buckets=buckets)


def skip_unchanged(incoming: DataFrame, stored: DataFrame | None, window_hours: float,
                   order: Sequence[str] = ("run_ts",), compare: Sequence[str] | None = None,
                   stage: Callable[[DataFrame], DataFrame] = staged) -> DataFrame:
    """The incoming rows worth writing, for one run or a replay of many.

    A row is dropped when the newest row written before it, less than
    `window_hours` old, has the same values. The last written value always equals
    the previous row's value, so a market's history splits into stretches of
    equal values: the first row of a stretch is written, later ones once the
    window since the last written has passed (`due_runs`).
    `stored` rows act as already written. A row for a stored (ticker, run)
    replaces it.
    """
    compare = list(compare or [c for c in incoming.columns if c not in KEY and c not in order])
    rows = last_wins(incoming, KEY, order)
    seq = rows.select(*KEY, F.struct(*compare).alias("_state"), F.lit(False).alias("_pinned"))
    if stored is not None:
        span = incoming.select(F.min("run_ts").alias("lo"), F.max("run_ts").alias("hi"))
        near = ((F.col("run_ts") > span.select("lo").scalar() - hours(window_hours))
                & (F.col("run_ts") < span.select("hi").scalar()))
        kept = stored.where(near).select(*KEY, F.struct(*compare).alias("_state"), F.lit(True).alias("_pinned"))
        # An incoming row replaces the stored one of the same key.
        seq = last_wins(seq.unionByName(kept).withColumn("_fresh", ~F.col("_pinned")), KEY, ["_fresh"]).drop("_fresh")
    w = Window.partitionBy("ticker").orderBy("run_ts")
    new_value = ~F.lag("_state").over(w).eqNullSafe(F.col("_state"))
    stretches = (seq.withColumn("_start", new_value.cast("int"))
                 .withColumn("_stretch", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                 .select(*KEY, "_stretch", "_pinned"))
    written = due_runs(stretches, ["ticker", "_stretch"], round(window_hours * 3600), stage)
    return rows.join(written.select(*KEY), KEY, "left_semi")


def due_runs(runs: DataFrame, keys: Sequence[str], window_seconds: int,
             stage: Callable[[DataFrame], DataFrame] = staged) -> DataFrame:
    """keys, run_ts of the runs to write in each stretch (`keys`) of `runs` (run_ts, _pinned).

    The first run is due, and then the first one `window_seconds` or more after the last that was due or pinned
    (written before). So every run points to the next one due after it, and those reachable from the first or a
    pinned one are wanted. Pointers are doubled: after k rounds of joins all within 2^k steps are found. No stretch is
    gathered, and the rounds grow with the logarithm of the longest chain, which its time span bounds.
    """
    keys = list(keys)
    if window_seconds <= 0:
        return runs.where(~F.col("_pinned")).select(*keys, "run_ts")
    second = seconds_between(F.col("run_ts"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    runs = runs.withColumn("_second", second)
    stretch = Window.partitionBy(*keys)
    # Backwards in time, so each frame grows by a row at a time.
    later = stretch.orderBy(F.desc("_second")).rangeBetween(Window.unboundedPreceding, -window_seconds)
    after = stretch.orderBy(F.desc("run_ts")).rowsBetween(Window.unboundedPreceding, -1)
    due, pinned = F.min("run_ts").over(later), F.last(F.when(F.col("_pinned"), F.col("run_ts")), ignorenulls=True).over(after)
    nodes = stage(runs.select(*keys, "run_ts", "_second", "_pinned", due.alias("_due"), pinned.alias("_reset"))
                  .withColumn("_first", F.lead("run_ts").over(stretch.orderBy(F.desc("run_ts"))).isNull()))
    # A pinned run is a start of its own, so no pointer has to lead to it.
    hop = F.when(F.col("_reset").isNull() | (F.col("_due") < F.col("_reset")), F.col("_due"))
    found = nodes.where(F.col("_first") | F.col("_pinned")).select(*keys, "run_ts", "_pinned")
    spans = nodes.groupBy(*keys).agg(F.count("*").alias("n"), (F.max("_second") - F.min("_second")).alias("span"))
    longest = spans.agg(F.max(F.least(F.col("n"), F.floor(F.col("span") / window_seconds) + 1))).first()[0] or 1
    rounds = (longest - 1).bit_length()
    if not rounds:
        return found.where(~F.col("_pinned")).drop("_pinned")
    jump = nodes.select(*keys, "run_ts", hop.alias("_to")).where("_to IS NOT NULL")
    for k in range(rounds):
        reached = found.join(jump, [*keys, "run_ts"]).select(*keys, F.col("_to").alias("run_ts"), F.lit(False).alias("_pinned"))
        found = found.unionByName(reached).distinct()
        if k + 1 < rounds:
            found = stage(found)
            onward = jump.select(*keys, F.col("run_ts").alias("_to"), F.col("_to").alias("_further"))
            jump = stage(jump.join(onward, [*keys, "_to"]).select(*keys, "run_ts", F.col("_further").alias("_to")))
    return found.where(~F.col("_pinned")).drop("_pinned")
