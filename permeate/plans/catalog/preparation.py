"""Gap filling, smoothing and thinning."""

from permeate.functions.missing import drop_missing
from permeate.operators import prepare as p
from permeate.operators.rolling import moving_average
from permeate.plans.adapter import ordered_log, sensor_log
from permeate.plans.registry import query, rounded
from permeate.storage import stage

_W = "(partition by unit_id order by us, seq rows between {} preceding and current row)"


def _narrow(spark, sf, *columns):
    return ordered_log(spark, sf).select("unit_id", "us", "seq", "rn", *columns)


@query(
    "d1_forward_fill",
    f"""select unit_id, seq, round(coalesce(perm_tc, last_value(perm_tc ignore nulls) over {_W.format(10)}), 6) as perm_tc
    from ordered""",
)
def forward_fill(spark, sf):
    return p.forward_fill(_narrow(spark, sf, "perm_tc"), ["perm_tc"]).select("unit_id", "seq", *rounded("perm_tc"))


_LINE = """, known as (select unit_id, seq, us, rn, perm_tc as v,
    last_value(case when perm_tc is not null then rn end ignore nulls)
      over (partition by unit_id order by rn rows between unbounded preceding and current row) as pr,
    first_value(case when perm_tc is not null then rn end ignore nulls)
      over (partition by unit_id order by rn rows between current row and unbounded following) as nr
  from ordered),
ends as (select k.*, a.perm_tc as pv, b.perm_tc as nv from known k
  left join ordered a on a.unit_id = k.unit_id and a.rn = k.pr
  left join ordered b on b.unit_id = k.unit_id and b.rn = k.nr),
filled as (select unit_id, seq, us, rn, coalesce(v, case when rn - pr <= 10
    then coalesce(pv + (nv - pv) * (rn - pr) / (nr - pr), pv) end) as perm_tc from ends)"""


@query("d2_interpolate", _LINE + " select unit_id, seq, round(perm_tc, 6) as perm_tc from filled")
def interpolate(spark, sf):
    return p.interpolate(_narrow(spark, sf, "perm_tc"), ["perm_tc"]).select("unit_id", "seq", *rounded("perm_tc"))


@query("d3_drop_rows", "select unit_id, seq, us, tmp, perm_tc from ordered where tmp is not null and perm_tc is not null")
def drop_rows(spark, sf):
    return drop_missing(sensor_log(spark, sf).select("unit_id", "seq", "us", "tmp", "perm_tc"))


@query(
    "d4_gated_fill",
    _LINE + """, flags as (select unit_id, max(step) > 9000000000 as has_gap
      from (select unit_id, us - lag(us) over (partition by unit_id order by us, seq) as step from ordered) group by 1)
    select o.unit_id, o.seq, round(case when has_gap then f.perm_tc else o.perm_tc end, 6) as perm_tc
    from ordered o join filled f using (unit_id, seq) join flags using (unit_id)""",
)
def gated(spark, sf):
    out = p.fill_gaps(_narrow(spark, sf, "perm_tc"), ["perm_tc"], "interpolate", max_minutes=150)
    return out.select("unit_id", "seq", *rounded("perm_tc"))


_STRIDE = """, sized as (select *, count(*) over (partition by unit_id) as n from ordered),
sampled as (select *, row_number() over (partition by unit_id order by rn) - 1 as srn from sized
  where n <= 300 or rn % (n // 300) = 0 or rn = n - 1)"""


@query("d5_stride_sample", _STRIDE + " select unit_id, seq, us, srn as rn, round(tmp, 6) as tmp from sampled")
def stride(spark, sf):
    return p.stride_sample(_narrow(spark, sf, "tmp"), 300).select("unit_id", "seq", "us", "rn", *rounded("tmp"))


@query(
    "d6_moving_average",
    f"""select unit_id, seq, round(avg(tmp) over {_W.format(49)}, 5) as tmp_sma,
    round(avg(recovery) over {_W.format(49)}, 5) as recovery_sma from ordered""",
)
def averages(spark, sf):
    log = _narrow(spark, sf, "tmp", "recovery")
    return moving_average(log, ["tmp", "recovery"], 50).select("unit_id", "seq", *rounded("tmp_sma", "recovery_sma", digits=5))


@query(
    "d7_sample_average",
    _STRIDE
    + """ select unit_id, seq, round(avg(tmp) over (partition by unit_id order by srn rows between 49 preceding and current row), 6)
    as tmp_sma from sampled""",
)
def sample_average(spark, sf):
    sample = stage(p.stride_sample(_narrow(spark, sf, "tmp"), 300), "sample")
    return moving_average(sample, ["tmp"], 50).select("unit_id", "seq", *rounded("tmp_sma"))
