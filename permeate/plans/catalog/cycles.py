"""Filtration periods, cleanings, cycles and fouling rates."""

from pyspark.sql import functions as F

from permeate.operators import cycles as c
from permeate.operators.joins import interval_join, next_after
from permeate.operators.ordering import row_index
from permeate.operators.quality import band_filter, in_band
from permeate.plans.adapter import BANDS, ORDERED_SQL, ordered_log, prepared
from permeate.plans.registry import query, rounded, stamp_text
from permeate.storage import stage

# Periods are found by comparing neighbours; rows are attached to them by an interval join.
PERIODS = ORDERED_SQL + """, runs as (select *, lag(program) over w as prev_program, coalesce(lead(us) over w, us) as next_us
  from ordered window w as (partition by unit_id order by rn)),
islands as (select *, sum(case when program = 10 and prev_program is distinct from 10 then 1 else 0 end)
  over (partition by unit_id order by rn) as island from runs),
periods as (select unit_id, min(rn) as period, min(us) as start_us, max(next_us) as end_us, count(*) as n_rows
  from islands where program = 10 group by unit_id, island)"""

CYCLES = PERIODS + """, members as (select o.*, p.period, count(*) over (partition by o.unit_id, p.period) as n,
    row_number() over (partition by o.unit_id, p.period order by o.us, o.seq) as k
  from ordered o join periods p on o.unit_id = p.unit_id and o.us between p.start_us and p.end_us
  where o.good and p.end_us - p.start_us >= 1800000000),
ids as (select unit_id, period, cast(row_number() over (partition by unit_id order by period) as int) as cycle_id
  from (select distinct unit_id, period from members where n >= 10)),
rows_in as (select m.*, i.cycle_id from members m join ids i using (unit_id, period))"""

METRICS = """select unit_id, cycle_id, min(us) as start_us, max(us) as end_us, (max(us) - min(us)) / 3600e6 as duration_hours,
    count(*) as n_rows,
    coalesce(median(tmp) filter (n > 10 and k between 11 and 60), arg_min(tmp, k)) as tmp_start,
    coalesce(median(tmp) filter (n > 10 and n - k + 1 between 11 and 50), arg_max(tmp, k)) as tmp_end,
    regr_slope(tmp, (us - 1704067200000000) / 1e6) * 3600 as tmp_slope,
    regr_r2(tmp, (us - 1704067200000000) / 1e6) as tmp_slope_r2,
    arg_min(perm_tc, k) as permeability_start, arg_max(perm_tc, k) as permeability_end,
    (arg_min(perm_tc, k) - arg_max(perm_tc, k)) / arg_min(perm_tc, k) * 100 as permeability_decline_percent,
    avg(flux) as avg_flux, avg(recovery) as avg_recovery, avg(mem_retention) as avg_retention
  from {rows} group by unit_id, cycle_id"""

CYCLE_TABLE = CYCLES + ", cycles as (" + METRICS.format(rows="rows_in") + ")"

CLEANINGS = """cleanings as (select unit_id, us, seq, rn, row_number() over (partition by unit_id order by us, seq) - 1 as no
  from (select *, lag(program) over (partition by unit_id order by rn) as before_it from ordered)
  where program = 32 and before_it is distinct from 32)"""

# Each cycle, in time order, takes the earliest unused cleaning of the three hours before it.
TAKEN = CYCLE_TABLE + ", " + CLEANINGS + """, seen as (select unit_id, cycle_id, start_us, tmp_start,
    (select count(*) from cleanings k where k.unit_id = c.unit_id and k.us < c.start_us) as arrived,
    (select count(*) from cleanings k where k.unit_id = c.unit_id and k.us < c.start_us - 10800000000) as expired
  from cycles c),
turns as (
  select unit_id, cycle_id, case when expired < arrived then expired end as taken,
    case when expired < arrived then expired + 1 else arrived end as gone from seen where cycle_id = 1
  union all
  select s.unit_id, s.cycle_id, case when greatest(t.gone, s.expired) < s.arrived then greatest(t.gone, s.expired) end,
    case when greatest(t.gone, s.expired) < s.arrived then greatest(t.gone, s.expired) + 1 else s.arrived end
  from turns t join seen s on s.unit_id = t.unit_id and s.cycle_id = t.cycle_id + 1),
taken as (select t.unit_id, t.cycle_id, s.start_us, s.tmp_start, k.us as cleaning_us
  from turns t join seen s using (unit_id, cycle_id) join cleanings k on k.unit_id = t.unit_id and k.no = t.taken)"""

DAYS = "((start_us - 1704067200000000) / 86400e6)"
RATES = TAKEN + f""", quart as (select unit_id, count(*) as total_cycles, quantile_cont(tmp_start, 0.25) as q1, quantile_cont(tmp_start, 0.75) as q3
  from cycles group by 1),
every as (select unit_id, count(*) as valid_cycles, regr_slope(tmp_start, {DAYS}) as slope, regr_r2(tmp_start, {DAYS}) as r2
  from cycles join quart using (unit_id) where tmp_start between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) group by 1),
post as (select unit_id, count(*) as post_cleaning_cycles, regr_slope(tmp_start, {DAYS}) as slope, regr_r2(tmp_start, {DAYS}) as r2
  from taken group by 1),
rates as (select unit_id, total_cycles, coalesce(valid_cycles, 0) as valid_cycles,
    case when valid_cycles >= 2 then e.slope end as reversible_rate, case when valid_cycles >= 2 then e.r2 end as reversible_r_squared,
    case when post_cleaning_cycles >= 2 then p.slope end as irreversible_rate,
    case when post_cleaning_cycles >= 2 then p.r2 end as irreversible_r_squared,
    total_cycles - coalesce(valid_cycles, 0) as outliers_removed,
    case when valid_cycles >= 2 then coalesce(post_cleaning_cycles, 0) else 0 end as post_cleaning_cycles
  from quart left join every e using (unit_id) left join post p using (unit_id))"""


def recursive(ctes: str) -> str:
    return "recursive " + ctes


def labelled(spark, sf):
    return prepared(spark, sf, "labelled", lambda: c.label_cycles(ordered_log(spark, sf), BANDS))


def cycle_table(spark, sf):
    return prepared(
        spark, sf, "cycles",
        lambda: c.cycle_metrics(labelled(spark, sf).filter("cycle_id > 0"), ["unit_id", "cycle_id"]),
    )


def cleaning_table(spark, sf):
    return prepared(spark, sf, "cleanings", lambda: c.chemical_cleanings(ordered_log(spark, sf)))


def rate_table(spark, sf):
    return prepared(spark, sf, "rates", lambda: c.fouling_rates(cycle_table(spark, sf), cleaning_table(spark, sf)))


@query("i1_filtration_periods", "select unit_id, period, start_us, end_us, n_rows from periods", PERIODS)
def periods(spark, sf):
    return c.filtration_periods(ordered_log(spark, sf))


@query(
    "i2_chemical_cleanings",
    "select unit_id, us, seq, rn, strftime(make_timestamp(us), '%Y-%m-%d %H:%M:%S.%f') as cleaning_time from cleanings",
    ORDERED_SQL + ", " + CLEANINGS,
)
def cleanings(spark, sf):
    return c.chemical_cleanings(ordered_log(spark, sf)).select("unit_id", "us", "seq", "rn", stamp_text("cleaning_time"))


DROPS = """drops as (select unit_id, rn, seq, us from (
    select *, dropped and not coalesce(lag(dropped) over (partition by unit_id order by rn), false) as starts from (
      select *, coalesce((peak - tmp) / nullif(peak, 0) * 100 > 4, false) as dropped from (
        select *, max(tmp) over (partition by unit_id order by rn rows between 1 preceding and current row) as peak from {rows})))
  where starts)"""
TIMER = """timer as (select unit_id, rn, seq, us from (
    select *, chemical_timer - lag(chemical_timer) over (partition by unit_id order by rn) as step from {rows}) where step > 0)"""
# Greedy thinning: from each kept event on to the first one more than 100 rows later.
MERGED = """events as (select unit_id, rn from drops union select unit_id, rn from timer),
merged as (select unit_id, min(rn) as rn from events group by 1
  union all
  select m.unit_id, (select min(e.rn) from events e where e.unit_id = m.unit_id and e.rn > m.rn + 100) as rn from merged m
  where exists (select 1 from events e where e.unit_id = m.unit_id and e.rn > m.rn + 100))"""


@query("i3_tmp_drops", "select unit_id, seq, us, rn from drops", ORDERED_SQL + ", " + DROPS.format(rows="ordered"))
def drops(spark, sf):
    return c.tmp_drops(ordered_log(spark, sf)).select("unit_id", "seq", "us", "rn")


@query("i4_timer_events", "select unit_id, seq, us, rn from timer", ORDERED_SQL + ", " + TIMER.format(rows="ordered"))
def timer(spark, sf):
    return c.timer_events(ordered_log(spark, sf)).select("unit_id", "seq", "us", "rn")


_EVENTS = ", ".join([ORDERED_SQL, DROPS.format(rows="ordered"), TIMER.format(rows="ordered")])


@query("i5_merged_events", "select unit_id, rn from merged", recursive(_EVENTS + ", " + MERGED))
def merged(spark, sf):
    log = ordered_log(spark, sf)
    return c.merge_events(c.tmp_drops(log), c.timer_events(log)).select("unit_id", "rn")


@query(
    "m2_distinct_events",
    "select unit_id, count(*) as n, min(rn) as first_rn, max(rn) as last_rn from (select unit_id, rn from drops union select unit_id, rn from timer) group by 1",
    _EVENTS,
)
def distinct_events(spark, sf):
    log = ordered_log(spark, sf)
    both = c.tmp_drops(log).select("unit_id", "rn").union(c.timer_events(log).select("unit_id", "rn")).distinct()
    return both.groupBy("unit_id").agg(F.count("*").alias("n"), F.min("rn").alias("first_rn"), F.max("rn").alias("last_rn"))


# The second way to find cycles works on the plausible rows, numbered anew.
_GOOD = ORDERED_SQL + """, plausible as (select * exclude (rn), row_number() over (partition by unit_id order by us, seq) - 1 as rn
  from ordered where good)"""
_SEGMENTS = ", ".join([_GOOD, DROPS.format(rows="plausible"), TIMER.format(rows="plausible"), MERGED]) + """,
segments as (select p.*, coalesce((select max(m.rn) from merged m where m.unit_id = p.unit_id and m.rn <= p.rn), 0) as segment from plausible p),
kept as (select unit_id, segment, count(*) as n, cast(row_number() over (partition by unit_id order by segment) as int) as cycle_id
  from segments group by 1, 2 having count(*) >= 10 and (max(us) - min(us)) / 3600e6 >= 0.5),
seg_rows as (select s.*, k.n, k.cycle_id, s.rn - s.segment + 1 as k from segments s join kept k using (unit_id, segment)),
seg_cycles as (""" + METRICS.format(rows="seg_rows") + ")"


@query(
    "i6_segments",
    "select unit_id, seq, coalesce(cycle_id, 0) as cycle_id from segments left join kept using (unit_id, segment)",
    recursive(_SEGMENTS),
)
def segments(spark, sf):
    good = prepared(spark, sf, "plausible", lambda: row_index(ordered_log(spark, sf).filter(in_band(BANDS)).drop("rn")))
    events = c.merge_events(c.tmp_drops(good), c.timer_events(good))
    return c.label_segments(good, events).select("unit_id", "seq", "cycle_id")


_METRIC_SQL = """select unit_id, cycle_id, start_us, end_us, duration_hours, n_rows, round(tmp_start, 6) as tmp_start, round(tmp_end, 6) as tmp_end,
  round(tmp_slope, 6) as tmp_slope, round(tmp_slope_r2, 6) as tmp_slope_r2, round(permeability_start, 6) as permeability_start,
  round(permeability_end, 6) as permeability_end, round(permeability_decline_percent, 6) as permeability_decline_percent,
  round(avg_flux, 6) as avg_flux, round(avg_recovery, 6) as avg_recovery, round(avg_retention, 6) as avg_retention from """


def _metric_columns(df):
    return df.select(
        "unit_id", "cycle_id", "start_us", "end_us", "duration_hours", "n_rows",
        *rounded(
            "tmp_start", "tmp_end", "tmp_slope", "tmp_slope_r2", "permeability_start", "permeability_end",
            "permeability_decline_percent", "avg_flux", "avg_recovery", "avg_retention",
        ),
    )


@query("i8_cycles_without_program", _METRIC_SQL + "seg_cycles", recursive(_SEGMENTS))
def without_program(spark, sf):
    return _metric_columns(c.find_cycles(ordered_log(spark, sf), BANDS, use_program=False))


@query(
    "i7_cycle_labels",
    """select o.unit_id, o.seq, coalesce(r.cycle_id, 0) as cycle_id from ordered o
      left join rows_in r on r.unit_id = o.unit_id and r.seq = o.seq where o.good""",
    CYCLES,
)
def labels(spark, sf):
    return c.label_cycles(ordered_log(spark, sf), BANDS).select("unit_id", "seq", "cycle_id")


@query("i9_cycle_metrics", _METRIC_SQL + "cycles", CYCLE_TABLE)
def metrics(spark, sf):
    return _metric_columns(c.cycles_by_program(ordered_log(spark, sf), BANDS))


@query(
    "g5_start_medians",
    "select unit_id, cycle_id, round(tmp_start, 6) as tmp_start, round(tmp_end, 6) as tmp_end from cycles",
    CYCLE_TABLE,
)
def medians(spark, sf):
    return cycle_table(spark, sf).select("unit_id", "cycle_id", *rounded("tmp_start", "tmp_end"))


@query("e12_row_ranks", "select unit_id, seq, cycle_id, k, n - k + 1 as from_end from rows_in", CYCLES)
def ranks(spark, sf):
    return labelled(spark, sf).filter("cycle_id > 0").select(
        "unit_id", "seq", "cycle_id", "k", (F.col("n") - F.col("k") + 1).alias("from_end")
    )


@query(
    "g12_cycle_statistics",
    """select unit_id, count(*) as n_cycles, round(avg(duration_hours), 6) as avg_duration_hours, round(avg(tmp_slope), 6) as avg_tmp_slope,
      round(avg(permeability_decline_percent), 5) as avg_permeability_decline from cycles group by 1""",
    CYCLE_TABLE,
)
def statistics(spark, sf):
    return c.cycle_statistics(cycle_table(spark, sf)).select(
        "unit_id", "n_cycles", *rounded("avg_duration_hours", "avg_tmp_slope"), *rounded("avg_permeability_decline", digits=5)
    )


@query(
    "h1_interval_join",
    "select o.unit_id, o.seq, p.period from ordered o join periods p on o.unit_id = p.unit_id and o.us between p.start_us and p.end_us where o.good",
    PERIODS,
)
def intervals(spark, sf):
    spans = stage(c.filtration_periods(ordered_log(spark, sf)).select("unit_id", "period", "start_us", "end_us"), "spans")
    rows = band_filter(ordered_log(spark, sf), BANDS).select("unit_id", "us", "seq")
    return interval_join(rows, spans).select("unit_id", "seq", "period")


@query(
    "h2_next_cleaning",
    """select p.unit_id, p.period, (select min(k.us) from cleanings k where k.unit_id = p.unit_id and k.us > p.start_us) as next_us from periods p""",
    PERIODS + ", " + CLEANINGS,
)
def next_cleaning(spark, sf):
    spans = c.filtration_periods(ordered_log(spark, sf)).select(
        "unit_id", "period", F.col("start_us").alias("us"), F.col("period").alias("seq")
    )
    return next_after(stage(spans, "spans"), cleaning_table(spark, sf)).select("unit_id", "period", "next_us")


@query("h3_first_cycle_after_cleaning", "select unit_id, cycle_id, start_us, cleaning_us from taken", recursive(TAKEN))
def taken(spark, sf):
    return c.post_cleaning_cycles(cycle_table(spark, sf), cleaning_table(spark, sf)).select(
        "unit_id", "cycle_id", "start_us", "cleaning_us"
    )


@query(
    "i10_fouling_rates",
    """select unit_id, total_cycles, valid_cycles, outliers_removed, post_cleaning_cycles, round(reversible_rate, 6) as reversible_rate,
      round(reversible_r_squared, 6) as reversible_r_squared, round(irreversible_rate, 6) as irreversible_rate,
      round(irreversible_r_squared, 6) as irreversible_r_squared from rates""",
    recursive(RATES),
)
def rates(spark, sf):
    return c.fouling_rates(cycle_table(spark, sf), cleaning_table(spark, sf)).select(
        "unit_id", "total_cycles", "valid_cycles", "outliers_removed", "post_cleaning_cycles",
        *rounded("reversible_rate", "reversible_r_squared", "irreversible_rate", "irreversible_r_squared"),
    )
