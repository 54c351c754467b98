"""DuckDB oracle SQL for each registered query.

Every oracle starts with the fixture views as CTEs (``clicks``,
``assessment_labels``, ``specs``) over the driver's pre-registered tables.
Doubles are rounded to 6 places, arrays are emitted as joined strings and
counts are BIGINT, in the oracle and in the Spark query alike.
"""

from __future__ import annotations

FIXTURE_CTES = """
_fx_e as (select *, lag(ts) over (partition by user_id order by ts, event_id) p from events),
_fx_s as (select *, sum(case when p is null or ts > p + interval 1 day then 1 else 0 end)
        over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) sno from _fx_e),
_fx_g as (select *, concat(cast(user_id as varchar(20)), '-', cast(sno as varchar(20))) game_session,
        min(ts) over (partition by user_id, sno) t0 from _fx_s),
clicks as (
select cast(event_id % 20 as int) event_id, event_id src_id, game_session, ts, user_id installation_id, cast(sno as int) sno,
  cast(row_number() over (partition by user_id, sno order by ts, event_id) as int) event_count,
  case event_type when 'signup' then 2000 when 'view' then 3010 when 'click' then 4070 when 'error' then 4020 else 4100 end event_code,
  event_type src_type,
  cast(floor((epoch_us(ts) - epoch_us(t0)) / 100000) as bigint) game_time,
  case (user_id + sno) % 5 when 0 then 'Bird Measurer (Assessment)' when 1 then 'Cart Balancer (Assessment)' when 2 then 'Cauldron Filler (Assessment)' when 3 then 'Chest Sorter (Assessment)' else 'Mushroom Sorter (Assessment)' end title,
  case sno % 3 when 0 then 'Assessment' when 1 then 'Game' else 'Activity' end type,
  case (user_id + sno) % 3 when 0 then 'TREETOPCITY' when 1 then 'MAGMAPEAK' else 'CRYSTALCAVES' end world
from _fx_g),
assessment_labels as (
select game_session, installation_id, title, num_correct, num_incorrect,
  case when num_correct = 0 then cast(0 as double) else cast(1 as double) / (1 + num_incorrect) end accuracy,
  case when num_correct = 0 then 0 when num_incorrect = 0 then 3 when num_incorrect = 1 then 2 else 1 end accuracy_group
from (select game_session, installation_id, min(title) title,
        max(case when src_type = 'purchase' then 1 else 0 end) num_correct,
        cast(sum(case when src_type = 'error' then 1 else 0 end) as int) num_incorrect
      from clicks where type = 'Assessment' group by game_session, installation_id) _fx_q),
specs as (
select * from (values (0,1,0),(1,0,1),(2,4,1),(3,1,2),(4,1,3),(5,1,4),(6,2,4),(7,0,5),(8,1,5),(9,2,5),(10,3,5),(11,4,5),
  (12,2,6),(13,0,7),(14,1,7),(15,2,7),(16,3,7),(17,4,7)) _fx_t(event_id, event_type, event_action))
"""


def with_fixtures(body: str, ctes: str = "") -> str:
    """Prefix an oracle body with the fixture CTEs (and optional extra CTEs)."""
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"with {FIXTURE_CTES.strip()}{extra}\n{body.strip()}"
