"""Queries over ordered rows: windows, splits, logs, timelines, running means."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackframe.operators import logs, sample, sequence, timeline
from trackframe.operators.position import running_totals
from trackframe.plans.dataset import build_windows as build_window_rows
from trackframe.registry.rows import listed, quota_sql
from trackframe.registry.tables import EVENTS_SQL, ITEM_FEATURES, Registry, events, items, rounded
from trackframe.session import scratch_path, stage
from trackframe.sources import files, sinks
from trackframe.spec import DatasetSpec, FeatureSpec, Vocabulary

registry = Registry()
STEPS = 4

WINDOWS_SQL = f"""{EVENTS_SQL},
 numbered as (select event_id, user_id, event_type, value, k, row_number() over (partition by user_id order by event_id) as rn,
              count(*) over (partition by user_id) as n from ev),
 win as (select event_id, user_id, event_type, value, k, (rn - 1) // {STEPS} as win_id, (rn - 1) % {STEPS} as win_pos
         from numbered where rn <= n // {STEPS} * {STEPS})"""


def user_events(spark, folder):
    return events(spark, folder).select("event_id", "user_id", "event_type", "value", "k", "bucket")


def user_windows(spark, folder):
    return sequence.fixed_windows(user_events(spark, folder), ["user_id"], ["event_id"], ["bucket"], STEPS)


@registry.add("truncate_multiple", f"with {WINDOWS_SQL} select event_id, user_id from win")
def truncate_multiple(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "bucket")
    return sequence.truncate_multiple(rows, ["user_id"], ["event_id"], ["bucket"], STEPS).drop("bucket")


@registry.add("fixed_windows", f"with {WINDOWS_SQL} select event_id, user_id, value, win_id, win_pos from win")
def fixed_windows(spark, folder):
    return user_windows(spark, folder).select("event_id", "user_id", "value", "win_id", "win_pos")


@registry.add("clean_windows", f"""with {WINDOWS_SQL},
 good as (select user_id, win_id from win group by all
          having count(*) filter (where value >= 20) = {STEPS} and count(distinct (event_type, k)) = {STEPS})
 select event_id, user_id, win_id, win_pos, event_type, k from win join good using (user_id, win_id)""")
def clean_windows(spark, folder):
    kept = sequence.clean_windows(user_windows(spark, folder), ["user_id"], F.col("value") >= 20, ["event_type", "k"], STEPS)
    return kept.select("event_id", "user_id", "win_id", "win_pos", "event_type", "k")


CUT_SQL = f"""cut as (select event_id, event_type, row_number() over (partition by event_type order by event_id) as rn,
  floor(count(*) over (partition by event_type) * 0.9::double)::bigint // {STEPS} * {STEPS} as train,
  count(*) over (partition by event_type) as n from events)"""


@registry.add("seq_split", f"""with {CUT_SQL}
 select event_id, event_type, case when rn <= train then 'train'
   when rn <= train + floor((n - train) * 0.5::double)::bigint // {STEPS} * {STEPS} then 'dev' else 'test' end as split from cut""")
def seq_split(spark, folder):
    rows = events(spark, folder).select("event_id", "event_type", "bucket")
    return sequence.seq_split(rows, "event_type", ["event_id"], ["bucket"], STEPS).drop("bucket")


@registry.add("window_tensor", f"""with {WINDOWS_SQL}
 select user_id, win_id, arg_min(event_type, win_pos) as label,
  max(value) filter (where win_pos = 0) as v0, max(value) filter (where win_pos = 1) as v1,
  max(value) filter (where win_pos = 2) as v2, max(value) filter (where win_pos = 3) as v3,
  max(k) filter (where win_pos = 0)::double as k0, max(k) filter (where win_pos = 1)::double as k1,
  max(k) filter (where win_pos = 2)::double as k2, max(k) filter (where win_pos = 3)::double as k3
 from win group by user_id, win_id""")
def window_tensor(spark, folder):
    stacked = sequence.window_tensor(user_windows(spark, folder), ["user_id"], ["value", "k"], "event_type")
    cell = lambda i, j: F.col("tensor")[i][j]
    return stacked.select(
        "user_id", "win_id", F.col("event_type").alias("label"), *[cell(i, 0).alias(f"v{i}") for i in range(STEPS)],
        *[cell(i, 1).alias(f"k{i}") for i in range(STEPS)],
    )


ERASE_WINDOWS = {"1": 40, "2": 10_000_000, "3": None}
WINDOW_SPEC = FeatureSpec(
    numbers=("value", "k"), matrix=(), extra=(), classes=("kind",), dedupe_ignore=("value",), nonzero=("k",),
    minimum={"value": 20.0},
)
KINDS = Vocabulary({"1": (1,), "2": (2,), "3": (3,), "4": (4,)})
KIND_SQL = "case event_type when 'click' then 1 when 'view' then 2 when 'error' then 3 when 'signup' then 4 else 9 end"
WINDOW_QUOTA = {"1": 500, "2": 2002, "4": 10_000_000}


def kinds(spark, folder):
    rows = events(spark, folder)
    kind = F.expr(KIND_SQL)
    return rows.select("event_id", "user_id", "bucket", "value", F.col("k").cast("double").alias("k"), kind.alias("kind"))


@registry.add("erase_windows", f"""with {WINDOWS_SQL},
 labelled as (select *, '' || {KIND_SQL} as label from win),
 ids as (select label, user_id, win_id, count(*) over (partition by label) as n_all,
   row_number() over (partition by label order by md5('42|' || user_id || '|' || win_id), user_id, win_id) as rn
   from (select distinct label, user_id, win_id from labelled)),
 kept as (select label, user_id, win_id from ids
   where label not in ({listed(ERASE_WINDOWS)})
      or rn > case label when '1' then {ERASE_WINDOWS['1'] // STEPS} else n_all end)
 select event_id, user_id, win_id, label from labelled join kept using (label, user_id, win_id)""")
def erase_windows(spark, folder):
    rows = user_windows(spark, folder).withColumn("label", F.expr(KIND_SQL).cast("string"))
    kept = sample.erase_windows(rows, "label", ERASE_WINDOWS, ["user_id", "win_id"], STEPS)
    return kept.select("event_id", "user_id", "win_id", "label")


@registry.add("build_windows", f"""with {EVENTS_SQL},
 known as (select event_id, user_id, value, k::double as k, '' || {KIND_SQL} as label from ev where {KIND_SQL} <> 9),
 numbered as (select *, row_number() over (partition by user_id, label order by event_id) as rn,
              count(*) over (partition by user_id, label) as n from known),
 win as (select *, (rn - 1) // {STEPS} as win_id, (rn - 1) % {STEPS} as win_pos from numbered where rn <= n // {STEPS} * {STEPS}),
 ranked as (select *, row_number() over (partition by label order by user_id, event_id) as place,
            count(*) over (partition by label) as n_all from win where label in ({listed(WINDOW_QUOTA)})),
 added as (select * from ranked where place <= ({quota_sql(WINDOW_QUOTA, 'label')}) // {STEPS} * {STEPS}),
 good as (select label, user_id, win_id from added group by all
          having count(*) filter (where k <> 0 and value >= 20) = {STEPS} and count(distinct k) = {STEPS})
 select event_id, user_id, label, win_id, win_pos, value, k from added join good using (label, user_id, win_id)""")
def build_windows(spark, folder):
    spec = DatasetSpec(
        data_dir="events", add=True, types=tuple(WINDOW_QUOTA), amounts=tuple(WINDOW_QUOTA.values()), time_series=STEPS,
        features=WINDOW_SPEC, vocabulary=KINDS,
    )
    built = build_window_rows(kinds(spark, folder), None, spec, "user_id", ["event_id"], ["bucket"])
    return built.select("event_id", "user_id", "label", "win_id", "win_pos", "value", "k")


@registry.add("running_mean", """select event_id, user_id, count(*) over w as n,
  (sum(round(value * 100)::bigint) over w)::double / (count(*) over w * 100) as mean from events
  window w as (partition by user_id order by event_id rows between unbounded preceding and current row)""")
def running_mean(spark, folder):
    """In whole cents, so that the order of additions cannot show."""
    rows = events(spark, folder).select("event_id", "user_id", "bucket", F.round(F.col("value") * 100).cast("long").alias("cents"))
    sums = running_totals(rows, ["user_id"], ["event_id"], ["bucket"], {"total": F.col("cents"), "n": F.lit(1)})
    mean = F.col("total").cast("double") / (F.col("n") * 100)
    return sums.select("event_id", "user_id", F.col("n").cast("long").alias("n"), mean.alias("mean"))


# Events play a console log per user: the number in a line is the value in tens.
PATTERNS = ["view", "click", "purchase"]
MARKER = 25.0
LOG_SQL = f"""recursive lines as (
   select user_id, event_id, event_type, floor(value / 10) as number,
     row_number() over (partition by user_id order by event_id) as rn from events),
 read as (
   select user_id, 0::bigint as rn, 0 as state, 0::bigint as done, null::varchar as event_type, null::double as number, false as taken
     from (select distinct user_id from lines)
   union all
   select l.user_id, l.rn,
     case when l.event_type = p.pattern then (r.state + 1) % 3 else r.state end,
     case when l.event_type = p.pattern and r.state = 2 then r.done + 1 else r.done end,
     l.event_type, l.number, l.event_type = p.pattern
   from read r join lines l on l.user_id = r.user_id and l.rn = r.rn + 1
     join (values (0, 'view'), (1, 'click'), (2, 'purchase')) p(state, pattern) on p.state = r.state),
 parts as (select user_id, case when event_type = 'purchase' then done - 1 else done end as record, event_type, number
           from read where taken),
 records as (select user_id, record, max(number) filter (where event_type = 'view') as a,
   max(number) filter (where event_type = 'click') as b, max(number) filter (where event_type = 'purchase') as c
   from parts group by user_id, record having count(*) = 3)"""


def user_records(spark, folder):
    """Through files: lines are written in order, the user in front, and scanned with their order key."""
    number = F.floor(F.col("value") / 10).cast("string")
    line = F.concat_ws(": ", F.col("event_id").cast("string"), "event_type", number)
    ordered = events(spark, folder).repartitionByRange("user_id", "event_id").sortWithinPartitions("user_id", "event_id")
    path = scratch_path(spark, "log")
    ordered.select(F.concat_ws("|", F.col("user_id").cast("string"), line).alias("value")).write.text(path)
    lines = files.scan_lines(spark, path).select(
        F.substring_index("value", "|", 1).cast("long").alias("user_id"), F.substring_index("value", "|", -1).alias("value"), *files.ORDER
    )
    # Places in a file depend on how it is split; written down they are the same for every pass.
    lines = stage(lines, "lines")
    return logs.log_records(lines, PATTERNS, ["a", "b", "c"], ["user_id"], list(files.ORDER), list(files.BUCKET))


@registry.add("log_records", f"with {LOG_SQL} select * from records")
def log_records(spark, folder):
    return user_records(spark, folder)


@registry.add("phase_split", f"""with {LOG_SQL},
 switches as (select user_id, min(record) as first from records where c = {MARKER} group by user_id)
 select records.*, case when record >= first then 2 else 1 end as phase from records left join switches using (user_id)""")
def phase_split(spark, folder):
    return logs.phase_split(stage(user_records(spark, folder), "records"), ["user_id"], "record", "c", MARKER)


@registry.add("measure_sorted", "select distinct l_quantity, l_discount, l_tax from lineitem")
def measure_sorted(spark, folder):
    columns = ITEM_FEATURES[:1] + ITEM_FEATURES[2:]
    return logs.measure_sorted(items(spark, folder), columns, columns)


# Hours x event types play a label timeline: the last value's class against the mean value's.
TYPES = ["click", "error", "purchase", "signup", "view"]


def level(value):
    return F.when(value < 100, "low").when(value < 300, "mid").otherwise("high")


def level_sql(value):
    return f"case when {value} < 100 then 'low' when {value} < 300 then 'mid' else 'high' end"


def wide_timeline(spark, folder):
    # Microseconds since midnight of day 0, so that the hour does not depend on a time zone.
    hour = F.floor(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '2024-01-01', ts)") / 3_600_000_000)
    columns = []
    for i, kind in enumerate(TYPES, 1):
        of_kind = F.col("event_type") == kind
        last = F.max_by(level(F.col("value")), F.when(of_kind, F.col("event_id")))
        mean = F.avg(F.when(of_kind, F.col("value")))
        seen = F.count_if(of_kind) > 0
        columns.append(F.when(seen, last).otherwise("_").alias(f"SystemTrack{i}"))
        columns.append(F.when(seen, level(mean)).otherwise("_").alias(f"SystemTrack{i}-Truth"))
    return events(spark, folder).groupBy(hour.cast("double").alias("Time")).agg(*columns)


LONG_SQL = f"""hours as (select floor((epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 3600000000.0)::double as time, * from events),
 cells as (select time, event_type, arg_max({level_sql('value')}, event_id) as pred, avg(value) as mean from hours group by all),
 grid as (select time, type as event_type, track from (select distinct time from hours),
          (values {', '.join(f"('{t}', {i})" for i, t in enumerate(TYPES, 1))}) t(type, track)),
 long as (select time, track, role, case role when 'pred' then pred when 'truth' then
            case when mean is not null then {level_sql('mean')} end end as value
          from grid left join cells using (time, event_type), (values ('pred'), ('truth')) r(role))"""
EXTENDED_SQL = f"""{LONG_SQL},
 starts as (select track, role, min(time) as start from long where value is not null group by all),
 gaps as (select track, role, min(time) as gap from long join starts using (track, role) where value is null and time > start group by all),
 carried as (select track, role, gap, arg_max(value, time) as carry from long join gaps using (track, role)
             where value is not null and time < gap group by all),
 extended as (select time, track, role, case when time = gap then carry else value end as value
              from long left join carried using (track, role))"""


@registry.add("timeline_long", f"with {LONG_SQL} select * from long")
def timeline_long(spark, folder):
    """Through a file: the wide table is written with a header and scanned again."""
    path = scratch_path(spark, "timeline")
    wide = wide_timeline(spark, folder)
    sinks.write_csv(wide, path, wide.columns)
    return timeline.timeline_long(files.scan_timeline(spark, path))


def extended_timeline(spark, folder):
    return timeline.extend_one(stage(timeline.timeline_long(wide_timeline(spark, folder)), "timeline"), ["track", "role"])


@registry.add("extend_one", f"with {EXTENDED_SQL} select * from extended")
def extend_one(spark, folder):
    return extended_timeline(spark, folder)


@registry.add("truth_vs_pred", f"""with {EXTENDED_SQL},
 pairs as (select track, time, max(value) filter (where role = 'pred') as pred, max(value) filter (where role = 'truth') as truth
           from extended group by all),
 held as (select *, coalesce(lead(time) over (partition by track order by time) - time, 0) as h from pairs),
 sums as (select track, min(time) as first_time, max(time) as last_time, count(*) as points,
   count(*) filter (where pred is not null and truth is not null) as compared, count(*) filter (where pred = truth) as agreed,
   coalesce(sum(h) filter (where truth is not null), 0) as truth_time,
   coalesce(sum(h) filter (where pred is not null and truth is not null), 0) as compared_time,
   coalesce(sum(h) filter (where pred = truth), 0) as agreed_time from held group by track)
 select *, round(agreed / compared, 6) as agree_share, round(compared_time / truth_time, 6) as covered_share,
   round(agreed_time / compared_time, 6) as agree_time_share from sums""")
def truth_vs_pred(spark, folder):
    long = extended_timeline(spark, folder).withColumn("day", F.floor(F.col("time") / 24))
    out = timeline.truth_vs_pred(long, ["track"], ["day"])
    return rounded(out, "agree_share", "covered_share", "agree_time_share")


@registry.add("trace_series", f"""with {EXTENDED_SQL},
 numbered as (select *, (row_number() over (partition by track, role order by time) - 1) // 200 as chunk from extended)
 select track, role, chunk, count(*) as n, min(time) as first_time, max(time) as last_time, sum(time) as time_sum,
  string_agg(coalesce(value, ''), ',' order by time) as shown from numbered group by track, role, chunk""")
def trace_series(spark, folder):
    long = extended_timeline(spark, folder).withColumn("day", F.floor(F.col("time") / 24))
    path = scratch_path(spark, "traces")
    made = timeline.trace_series(long, ["track", "role"], ["day"], chunk_rows=200)
    sinks.write_traces(made, path)
    traces = spark.read.schema(made.schema).json(path)
    return traces.select(
        "track", "role", "chunk", F.size("times").alias("n"), "first_time", "last_time",
        F.aggregate("times", F.lit(0.0), lambda a, x: a + x).alias("time_sum"),
        F.array_join(F.transform("values", lambda v: F.coalesce(v, F.lit(""))), ",").alias("shown"),
    )
