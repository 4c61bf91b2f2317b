"""Windowed aggregates, state transitions, entity rollups and histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WINDOW_MS = 300_000


def window_start(ms: Column, width: int = WINDOW_MS) -> Column:
    return ms - F.pmod(ms, F.lit(width))


def metric_windows(readings: DataFrame, keys: list[str], ms: str, value: str, width: int = WINDOW_MS) -> DataFrame:
    """Tumbling windows: count, min, max, and the sum as text, so that mean = sum / count stays exact. Rows without time or value are left out."""
    rows = readings.where(F.col(ms).isNotNull() & F.col(value).isNotNull())
    v = F.col(value)
    return rows.groupBy(*keys, window_start(F.col(ms), width).alias("window_start_ms")).agg(
        F.count("*").alias("n"), F.min(v).alias("value_min"), F.max(v).alias("value_max"), F.sum(v.cast("decimal(38,0)")).cast("string").alias("value_sum")
    )


def measure_windows(events: DataFrame, keys: list[str], ms: str, measures: list[str], outcome: str, width: int = WINDOW_MS) -> DataFrame:
    """Tumbling windows over several measures: observed and missing counts (never filled with zeros), min, max, sum, and the outcome histogram as sorted text."""
    rows = events.where(F.col(ms).isNotNull()).withColumn("window_start_ms", window_start(F.col(ms), width))
    by = [*keys, "window_start_ms"]
    aggs: list[Column] = [F.count("*").alias("n_events")]
    for m in measures:
        aggs += [
            F.count(m).alias(f"{m}_observed"), F.count_if(F.col(m).isNull()).alias(f"{m}_missing"), F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max"), F.sum(m).alias(f"{m}_sum")
        ]
    # the outcomes are counted first, so the histogram gathers one entry per outcome
    per = rows.groupBy(*by, F.coalesce(F.col(outcome), F.lit("unknown")).alias("_o")).agg(F.count("*").alias("_n"))
    label = F.concat(F.col("_o"), F.lit("="), F.col("_n").cast("string"))
    histogram = per.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(label)), ";").alias("outcomes"))
    return rows.groupBy(*by).agg(*aggs).join(histogram, by)


def _shard(ordered: str, width: int) -> Column:
    return F.floor(F.col(ordered) / F.lit(width)).cast("long")


def with_previous(rows: DataFrame, series: list[str], ordered: str, value: Column, width: int, name: str = "previous") -> DataFrame:
    """Each row with a value of the row before it in its series (null for the first), and ``is_first``.

    ``ordered`` is a number without ties within a series. The series is cut
    into shards of ``width``: a row looks back within its shard, and the first
    row of a shard gets the last value of the shard before, carried by a scan
    over one summary row per shard. So a series that holds a third of all rows
    is spread over many tasks. Presence is kept apart from the value, so null
    values carry over as null.
    """
    r = rows.withColumns({"_shard": _shard(ordered, width), "_value": value})
    inside = Window.partitionBy(*series, "_shard").orderBy(ordered)
    r = r.withColumns({"_back": F.lag("_value").over(inside), "_lead": F.lag(F.lit(1)).over(inside).isNull()})
    last = rows.withColumns({"_shard": _shard(ordered, width), "_value": value}).groupBy(*series, "_shard").agg(F.max_by(F.struct("_value"), F.col(ordered)).alias("_last"))
    scan = Window.partitionBy(*series).orderBy("_shard")
    carried = last.select(*series, "_shard", F.lag("_last").over(scan).alias("_carried"))
    out = r.join(carried, [*series, "_shard"], "left")
    return out.select(
        *rows.columns,
        F.when(F.col("_lead"), F.col("_carried._value")).otherwise(F.col("_back")).alias(name),
        (F.col("_lead") & F.col("_carried").isNull()).alias("is_first"),
    )


#: Shards of ordered series: one day of microseconds.
SHARD_US = 86_400_000_000


def state_transitions(states: DataFrame, series: list[str], time: str, state: str, event: str, shard: int = SHARD_US) -> DataFrame:
    """One row per series and moment with its outcome.

    Rows of the same moment are one group; with more than one distinct state
    it is 'ambiguous' and the next group has no predecessor. Else 'initial',
    'no_predecessor', 'unchanged' or 'transition'. The smallest event stands
    for its group. Rows without series, time or state are left out. ``time``
    is a number, ``shard`` the width of a time shard in its unit.
    """
    ok = F.lit(True)
    for c in [*series, time, state]:
        ok = ok & F.col(c).isNotNull()
    # min and max tell whether there is more than one state, without a distinct set
    groups = states.where(ok).groupBy(*series, time).agg(F.min(state).alias("_low"), F.max(state).alias("_high"), F.min(event).alias("event"))
    one = F.col("_low") == F.col("_high")
    rows = with_previous(groups, series, time, F.when(one, F.col("_low")), shard, "previous_state")
    outcome = (
        F.when(~one, "ambiguous")
        .when(F.col("is_first"), "initial")
        .when(F.col("previous_state").isNull(), "no_predecessor")
        .when(F.col("previous_state") == F.col("_low"), "unchanged")
        .otherwise("transition")
    )
    return rows.select(*series, time, "event", F.when(one, F.col("_low")).alias("state"), "previous_state", outcome.alias("outcome"))


def _count_before(marks: DataFrame, keys: list[str], time: str, width: int) -> DataFrame:
    """Marks (keys, time, _w) with ``_before``: the sum of _w of the same keys at strictly smaller times; counted by shards with carried totals."""
    cells = marks.groupBy(*keys, time).agg(F.sum("_w").alias("_w")).withColumn("_shard", _shard(time, width))
    inside = F.coalesce(F.sum("_w").over(Window.partitionBy(*keys, "_shard").orderBy(time).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    totals = cells.groupBy(*keys, "_shard").agg(F.sum("_w").alias("_t"))
    carried = F.coalesce(F.sum("_t").over(Window.partitionBy(*keys).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return cells.withColumn("_in", inside).join(totals.select(*keys, "_shard", carried.alias("_carry")), [*keys, "_shard"]).select(*keys, time, (F.col("_in") + F.col("_carry")).alias("_before"))


def strict_history(events: DataFrame, keys: list[str], time: str, back: int | None = None, shard: int = SHARD_US) -> DataFrame:
    """Each row with ``prior``: the rows of its keys strictly before it, over all the past or the last ``back``.

    Counts come from time shards with carried totals, so no task ever holds
    all rows of one key. A bounded history is the difference of two prefix
    counts. Rows with a null key or time have a null count.
    """
    ok = F.lit(True)
    for c in [*keys, time]:
        ok = ok & F.col(c).isNotNull()
    marks = events.where(ok).select(*keys, F.col(time).alias("_t"), F.lit(1).cast("long").alias("_w"))
    if back is not None:  # moments at which the history begins, as marks of weight 0
        marks = marks.unionByName(events.where(ok).select(*keys, (F.col(time) - back).alias("_t"), F.lit(0).cast("long").alias("_w")))
    before = _count_before(marks, keys, "_t", shard)
    out = events.join(before.select(*keys, F.col("_t").alias(time), F.col("_before").alias("_upto")), [*keys, time], "left")
    if back is None:
        return out.select(*events.columns, F.col("_upto").alias("prior"))
    start = before.select(*keys, (F.col("_t") + back).alias(time), F.col("_before").alias("_gone"))
    return out.join(start, [*keys, time], "left").select(*events.columns, (F.col("_upto") - F.col("_gone")).alias("prior"))


def interval_union(intervals: DataFrame, keys: list[str], start: str, end: str, shard: int = 86_400_000) -> DataFrame:
    """(keys, islands, covered): the total length of the union of half-open intervals; empty ones don't count, touching ones join.

    Every interval adds what reaches beyond the furthest end before it, and
    opens an island if it starts beyond that end. The furthest end is carried
    over time shards by a scan of one summary row per shard.
    """
    rows = intervals.where(F.col(start) < F.col(end)).select(*keys, F.col(start).alias("_s"), F.col(end).alias("_e")).withColumn("_shard", _shard("_s", shard))
    inside = F.max("_e").over(Window.partitionBy(*keys, "_shard").orderBy("_s", "_e").rowsBetween(Window.unboundedPreceding, -1))
    last = rows.groupBy(*keys, "_shard").agg(F.max("_e").alias("_m"))
    scan = F.max("_m").over(Window.partitionBy(*keys).orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1))
    carried = last.select(*keys, "_shard", scan.alias("_carry"))
    r = rows.withColumn("_in", inside).join(carried, [*keys, "_shard"]).withColumn("_reach", F.greatest("_in", "_carry"))
    return r.groupBy(*keys).agg(
        F.count_if(F.col("_reach").isNull() | (F.col("_s") > F.col("_reach"))).alias("islands"),
        F.sum(F.greatest(F.lit(0), F.col("_e") - F.greatest("_s", "_reach"))).alias("covered"),
    )


def scope_lists(participants: DataFrame) -> DataFrame:
    """(event_id, scopes): the sorted distinct role:entity list of each event as one text."""
    rows = participants.where("event_id is not null and entity_id is not null and role is not null").select("event_id", "role", "entity_id").distinct()
    entry = F.concat_ws(":", "role", "entity_id")
    return rows.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_list(entry)), ",").alias("scopes"))


def entity_rollup(entities: DataFrame, participants: DataFrame, events: DataFrame) -> DataFrame:
    """Per entity: distinct events, relations and roles, and its most frequent role (ties: the smaller).

    Repeated participant rows count once. Participants are made distinct and
    summed per (entity, relation, role) before they meet the entity, so one
    entity with a tenth of all rows is a matter of partial sums.
    """
    relation = events.where("event_id is not null").groupBy("event_id").agg(F.min("relation_name").alias("relation_name"))
    rows = participants.where("event_id is not null and entity_id is not null").select("event_id", "entity_id", F.coalesce("role", F.lit("")).alias("role")).distinct()
    cells = rows.join(relation, "event_id", "left").groupBy("entity_id", "relation_name", "role").agg(F.count("*").alias("n"))
    roles = cells.groupBy("entity_id", "role").agg(F.sum("n").alias("n"))
    main = roles.groupBy("entity_id").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("role"))).getField("role").alias("main_role"), F.count("*").alias("n_roles"))
    total = cells.groupBy("entity_id").agg(F.sum("n").alias("participations"), F.countDistinct("relation_name").alias("n_relations"))
    return (
        entities.select("entity_id", "kind")
        .join(total, "entity_id", "left")
        .join(main, "entity_id", "left")
        .select("entity_id", "kind", F.coalesce("participations", F.lit(0)).alias("participations"), F.coalesce("n_relations", F.lit(0)).alias("n_relations"), F.coalesce("n_roles", F.lit(0)).alias("n_roles"), "main_role")
    )
