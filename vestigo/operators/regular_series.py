"""Irregular readings onto a regular grid.

Every series is cut into time shards. Readings become window cells, each shard
gives a summary of its first and last cell, a prefix scan over these summaries
carries the last value across shard borders, and then every shard (and every
stretch of empty shards) is filled on its own. A series of any length or
weight is so spread over many tasks.
"""

from __future__ import annotations

from datetime import UTC, datetime
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestigo.functions.jsons import REFUSED, json_reader

STEP_MS = 300_000
#: Windows in a time shard: one day of five-minute windows.
SHARD_WINDOWS = 288
#: Shards of a gap that are filled together.
STEP_SHARDS = 50_000
#: Windows written at once.
FILL_ROWS = 100_000


def window_cells(readings: DataFrame, series: list[str], time_ms: str, value: str, step: int = STEP_MS) -> DataFrame:
    """One row per series and window that holds a reading: n_readings, value_sum, value_min, value_max, last_value.

    Rows with a null series part, time or value are no readings. Windows start
    at multiples of ``step`` since 1970, also before it. Of readings at the
    same last moment the largest value is the last one.
    """
    ok = F.lit(True)
    for c in [*series, time_ms, value]:
        ok = ok & F.col(c).isNotNull()
    slim = readings.where(ok).select(*[F.col(c) for c in series], F.col(time_ms).cast("long").alias("_t"), F.col(value).alias("_v"))
    start = F.col("_t") - F.pmod("_t", F.lit(step))
    return slim.groupBy(*series, start.alias("window_start_ms")).agg(
        F.count("*").alias("n_readings"),
        F.sum("_v").alias("value_sum"),
        F.min("_v").alias("value_min"),
        F.max("_v").alias("value_max"),
        F.max(F.struct("_t", "_v")).getField("_v").alias("last_value"),
    )


def _spread(gaps: DataFrame, series: list[str], step: int, shard_ms: int) -> DataFrame:
    """The windows strictly between ``_from`` and ``_to``: gaps are cut into steps of whole shards, and each step's windows are written in batches, so that memory doesn't grow with a gap."""
    shard = lambda c: F.floor(c / F.lit(shard_ms))
    first, last = F.col("_from") + step, F.col("_to") - step
    wide = gaps.where(F.col("_to") - F.col("_from") > step).select(*series, "_carry", first.alias("_a"), last.alias("_b"))
    starts = F.explode(F.sequence(shard(F.col("_a")), shard(F.col("_b")), F.lit(STEP_SHARDS).cast("long"))).alias("_s")
    low = F.greatest(F.col("_a"), F.col("_s") * shard_ms)
    # the first step begins within the gap's first shard, every other one at the border of a shard
    high = F.least(F.col("_b"), (F.col("_s") + STEP_SHARDS) * shard_ms - step)
    steps = wide.select(*series, "_carry", "_a", "_b", starts).select(*series, "_carry", low.alias("_a"), high.alias("_b"))
    names = [*series, "_carry"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a = b.column(len(names)).to_numpy()
            left = (b.column(len(names) + 1).to_numpy() - a) // step + 1
            row, done = 0, 0
            while row < len(left):
                rows, at, count, room = [], [], [], FILL_ROWS
                while row < len(left) and room:
                    n = min(int(left[row]) - done, room)
                    rows.append(row), at.append(int(a[row]) + done * step), count.append(n)
                    room, done = room - n, done + n
                    if done == left[row]:
                        row, done = row + 1, 0
                count = np.array(count)
                place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                pick = pa.array(np.repeat(rows, count))
                yield pa.RecordBatch.from_arrays([*[b.column(i).take(pick) for i in range(len(names))], pa.array(np.repeat(at, count) + place * step)], [*names, "window_start_ms"])

    kinds = dict(steps.dtypes)
    return steps.mapInArrow(fill, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", window_start_ms long")


def gaps_between(cells: DataFrame, series: list[str], step: int = STEP_MS, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """(series, _from, _to, _carry): neighbouring cells of a series that aren't adjacent windows, with the value before the gap."""
    shard_ms = step * shard_windows
    slim = cells.select(*series, F.col("window_start_ms").alias("_w"), "last_value").withColumn("_shard", F.floor(F.col("_w") / shard_ms))
    in_shard = Window.partitionBy(*series, "_shard").orderBy("_w")
    inner = slim.select(*series, F.lag("_w").over(in_shard).alias("_from"), F.col("_w").alias("_to"), F.lag("last_value").over(in_shard).alias("_carry"))
    summary = slim.groupBy(*series, "_shard").agg(
        F.min("_w").alias("_first"), F.max("_w").alias("_last"), F.max(F.struct("_w", "last_value")).getField("last_value").alias("_end")
    )
    scan = Window.partitionBy(*series).orderBy("_shard")
    border = summary.select(*series, F.lag("_last").over(scan).alias("_from"), F.col("_first").alias("_to"), F.lag("_end").over(scan).alias("_carry"))
    return inner.unionByName(border).where(F.col("_from").isNotNull() & (F.col("_to") - F.col("_from") > step))


def missing_windows(cells: DataFrame, series: list[str], step: int = STEP_MS, shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """(series, window_start_ms, carried_value) of every window between the first and the last cell of a series that has no cell."""
    gaps = gaps_between(cells, series, step, shard_windows)
    return _spread(gaps, series, step, step * shard_windows).select(*series, "window_start_ms", F.col("_carry").alias("carried_value"))


def regular_series(
    readings: DataFrame, series: list[str], time_ms: str, value: str, step: int = STEP_MS, shard_windows: int = SHARD_WINDOWS
) -> DataFrame:
    """The regular series: every window from the first to the last with a reading.

    Windows without one are marked ``is_missing`` and hold the last value
    before them in ``carried_value``; their other values are null.
    """
    cells = window_cells(readings, series, time_ms, value, step)
    held = cells.select(*series, "window_start_ms", F.lit(False).alias("is_missing"), "n_readings", "value_sum", "value_min", "value_max", F.col("last_value").alias("carried_value"))
    return held.unionByName(missing_windows(cells, series, step, shard_windows).withColumns({"is_missing": F.lit(True), "n_readings": F.lit(0).cast("long")}), allowMissingColumns=True)


def epoch_ms(value: object) -> int | None:
    """Milliseconds since 1970 of a number not below 0 (from 1e17 on ns, 1e14 us, 1e11 ms, else s) or an ISO 8601 text with zone."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if not value >= 0 or value >= 1e30:
            return None
        whole = isinstance(value, int)
        for least, up, down in ((1e17, 1, 1_000_000), (1e14, 1, 1000), (1e11, 1, 1)):
            if value >= least:
                return value // down if whole else int(value / down)
        return value * 1000 if whole else int(value * 1000)
    if isinstance(value, str):
        try:
            t = datetime.fromisoformat(value)
        except ValueError:
            return None
        if t.tzinfo is None:
            return None
        gap = t - datetime(1970, 1, 1, tzinfo=UTC)
        return (gap.days * 86_400 + gap.seconds) * 1000 + gap.microseconds // 1000
    return None


def metric_value(value: object) -> int | None:
    """An integer number, or a text of ASCII digits with an optional leading minus; within 64 bits."""
    if isinstance(value, str):
        digits = value[1:] if value.startswith("-") else value
        value = int(value) if digits.isascii() and digits.isdigit() else None
    if isinstance(value, int) and not isinstance(value, bool) and -(2**63) <= value < 2**63:
        return value
    return None


def metric_readings(events: DataFrame, event_times: DataFrame, json: str = "typed_event_json") -> DataFrame:
    """(event_id, source_id, metric, time_ms, value) of metric events.

    ``events``: event_id and the JSON text. ``event_times``: event_id and
    event_time; its time wins over ``header.time`` in the JSON; of several
    times of an event the earliest counts. Equal readings of an event that was
    delivered again count once. Texts that aren't a JSON object as
    a whole, objects without a text source_id and metric, readings without any
    time and without a valid value are left out.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = json_reader()
        for b in batches:
            rows: list[list] = [[], [], [], [], []]
            for event, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                o = read(text)
                if o is REFUSED or not isinstance(o, dict):
                    continue
                head = o.get("header")
                source, metric = head.get("source_id") if isinstance(head, dict) else None, o.get("metric")
                value = metric_value(o.get("value_milli"))
                if not isinstance(source, str) or not isinstance(metric, str) or value is None:
                    continue
                own = epoch_ms(head.get("time"))
                for col, v in zip(rows, (event, source, metric, own if own is None or own < 2**62 else None, value)):
                    col.append(v)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], ["event_id", "source_id", "metric", "own_ms", "value"])

    parsed = events.select("event_id", json).mapInArrow(parse, "event_id string, source_id string, metric string, own_ms long, value long")
    times = event_times.where("event_id is not null and event_time is not null").groupBy("event_id").agg(F.min("event_time").alias("_at"))
    ms: Column = F.coalesce(F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / 1000).cast("long"), F.col("own_ms"))
    timed = parsed.join(times, "event_id", "left").select("event_id", "source_id", "metric", ms.alias("time_ms"), "value").where("time_ms is not null")
    return timed.distinct()  # the join has already brought an event's rows together
