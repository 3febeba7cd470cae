"""Counts over sliding windows, without a copy of every event per window.

Windows are aligned to the epoch and half-open, as Spark's own `window` function cuts them.
"""

from pyspark.sql import DataFrame, Window, functions as F

from pageflow.functions.durations import panes_per_window, seconds


def sliding_counts(events: DataFrame, keys: list, window: str, slide: str, above: int = 0,
                   method: str = "blocks") -> DataFrame:
    """Rows per (keys, window) with more than `above` events: keys, window_start, window_end, pages.

    Both methods give the same rows for any window. "blocks" copies each event twice at most, into rows with a
    column per slide; it suits windows of up to some dozens of slides. "panes" counts slides first and sums up
    how the count changes from window to window; it suits windows of any number of slides.
    """
    width, step, panes = seconds(window), seconds(slide), panes_per_window(window, slide)
    timed = events.where(F.col("event_time").isNotNull())
    if method not in ("blocks", "panes"):
        raise ValueError(f"no such method: {method!r}")
    if method == "blocks":
        counts = _block_counts(timed, keys, width, step, panes, above)
    else:
        counts = _pane_counts(timed, keys, width, slide, step, above)
    return counts.select(
        *keys,
        F.timestamp_seconds("start").alias("window_start"),
        F.timestamp_seconds(F.col("start") + width).alias("window_end"),
        "pages")


def _block_counts(timed: DataFrame, keys: list, width: int, step: int, panes: int, above: int) -> DataFrame:
    """(keys, start in seconds, pages) by blocks of two window lengths.

    Blocks start every window length, so each window lies whole in the block its start falls
    in. Every event goes to its two blocks; one aggregation counts a block per slide, and the
    windows are sums of neighbouring counts. One shuffle, and two copies per event at most
    (before map-side combining), whatever the number of slides.
    """
    at = F.unix_seconds("event_time")
    own = at - F.pmod(at, F.lit(width))
    placed = timed.select(*keys, at.alias("at"), F.explode(F.array(own, own - width)).alias("block"))
    slots = [f"slot_{i}" for i in range(2 * panes - 1)]
    blocks = placed.withColumn("slot", F.expr(f"(at - block) div {step}")).groupBy(*keys, "block").agg(
        *[F.count_if(F.col("slot") == i).alias(name) for i, name in enumerate(slots)])

    def total(names):
        return sum((F.col(n) for n in names[1:]), F.col(names[0]))

    windows = F.array(*[
        F.struct((F.col("block") + i * step).alias("start"), total(slots[i:i + panes]).alias("pages"))
        for i in range(panes)])
    busy = blocks.where(total(slots) > above)
    return busy.select(*keys, F.inline(F.filter(windows, lambda w: w["pages"] > above)))


def _pane_counts(timed: DataFrame, keys: list, width: int, slide: str, step: int, above: int) -> DataFrame:
    """The same by slides: events are counted per slide, and a running sum over the slides gives the windows.

    As a window moves on, its count changes only where a slide with events enters or leaves it. Each slide gives at most three
    such changes in the blocks of one window length (as above) that the windows' starts lie in, whatever the number of
    slides. Between two changes all windows have the same count, and only those with enough events are written out.
    """
    pane, pages = F.unix_seconds("pane"), F.col("pages")
    panes = timed.groupBy(*keys, pane_start(slide).alias("pane")).agg(F.count("*").alias("pages"))
    own = pane - F.pmod(pane, F.lit(width))

    def change(block, at, pages):
        return F.struct(block.alias("block"), at.alias("at"), pages.alias("pages"))

    # In its own block a slide is in the windows from the first one up to that it starts; in the block before, from the
    # window that it ends to the last one.
    changes = F.array(
        change(own, own, pages), change(own, pane + step, -pages), change(own - width, pane + step - width, pages))
    within = F.filter(changes, lambda c: c["at"] < c["block"] + width)
    by_start = Window.partitionBy(*keys, "block").orderBy("at")
    runs = panes.select(*keys, F.inline(within)).select(
        *keys, "at", F.lead("at").over(by_start).alias("next"), (F.col("block") + width).alias("end"),
        F.sum("pages").over(by_start.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("pages"))
    until = F.coalesce("next", "end")
    busy = runs.where((F.col("at") < until) & (F.col("pages") > max(above, 0)))
    return busy.select(*keys, F.explode(F.sequence("at", until - step, F.lit(step).cast("bigint"))).alias("start"), "pages")


def pane_start(slide: str):
    """Start of the slide-long pane an event falls in."""
    at = F.unix_seconds("event_time")
    return F.timestamp_seconds(at - F.pmod(at, F.lit(seconds(slide))))
