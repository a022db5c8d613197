"""The registered queries as DuckDB SQL over the same sample tables."""

# Written out, and not taken from the code they check.
BASELINES = {
    "heart_rate": "Normal resting heart rate: 60-100 bpm. Below 60 may indicate bradycardia; "
    "above 100 may indicate tachycardia.",
    "spo2": "Normal SpO2: 95-100%. Below 95% may indicate hypoxemia and warrants medical "
    "attention.",
    "steps": "Recommended daily steps: 8,000-10,000. Fewer than 5,000 is considered sedentary.",
}
NO_BASELINE = "No specific baseline available."

READINGS = """
readings as (
  select event_id, ts as event_ts,
         'user_' || case when user_id < 10000 then lpad(cast(user_id as varchar), 4, '0')
                         else cast(user_id as varchar) end as user_id,
         date_trunc('second', ts) as event_at,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as "timestamp",
         case when event_id % 37 = 0 then null
              else cast(40 + cast(floor(value) as bigint) % 230 as integer) end as heart_rate,
         case when event_id % 41 = 0 then -1 else cast(event_id % 51 as integer) end as steps,
         case when event_id % 97 = 0 then 65.0::double
              when event_id % 20 = 7 then (880 + event_id % 31) / 10.0::double
              else (940 + event_id % 61) / 10.0::double end as spo2
  from events)"""

BRONZE = (
    READINGS
    + """,
bronze as (
  select event_id,
         case when event_id % 101 <> 0 then user_id end as user_id,
         case when event_id % 101 <> 0 then "timestamp" end as "timestamp",
         case when event_id % 101 <> 0 then heart_rate end as heart_rate,
         case when event_id % 101 <> 0 then steps end as steps,
         case when event_id % 101 <> 0 then spo2 end as spo2,
         cast(event_id % 3 as integer) as kafka_partition,
         cast(floor(event_id / 3) as bigint) as kafka_offset,
         case when event_id % 101 <> 0 then cast(event_at as date) end as "date",
         event_at
  from readings)"""
)

SILVER = (
    BRONZE
    + """,
silver as (
  select *, heart_rate > 130 or spo2 < 92 as is_anomaly
  from bronze
  where heart_rate between 30 and 220 and spo2 between 70 and 100 and steps >= 0)"""
)

GOLD = (
    SILVER
    + """,
gold as (
  select user_id,
         avg(heart_rate) as avg_heart_rate, avg(spo2) as avg_spo2,
         cast(sum(steps) as bigint) as total_steps, count(*) as event_count,
         date_trunc('hour', event_at) as window_start,
         date_trunc('hour', event_at) + interval 1 hour as window_end,
         cast(date_trunc('hour', event_at) as date) as "date"
  from silver group by user_id, date_trunc('hour', event_at))"""
)

POINTS = (
    GOLD
    + """,
points as (
  select user_id, window_end as "time", 'heart_rate' as metric_name, avg_heart_rate as value
  from gold
  union all
  select user_id, window_end, 'steps', cast(total_steps as double) from gold
  union all
  select user_id, window_end, 'spo2', avg_spo2 from gold)"""
)


def summary(hours: int = 24) -> str:
    """Common table expressions up to the look-back summary."""
    return (
        POINTS
        + f""",
placed as (
  select *,
         row_number() over (partition by user_id, metric_name order by "time", value) as place,
         count(*) over (partition by user_id, metric_name) as points
  from points
  where value is not null
    and "time" >= timestamp '2024-01-31 00:00:00' - interval {hours} hours),
stats as (
  select user_id, metric_name,
         min(value) as lo, max(value) as hi,
         sum(value order by "time", value) / count(*) as mean,
         arg_max(value, "time") as last_value,
         count(*) as window_count,
         sum(value order by "time", value) filter (where place <= points // 2)
           / any_value(points // 2) as first_mean,
         sum(value order by "time", value) filter (where place > points // 2)
           / any_value(points - points // 2) as second_mean
  from placed group by user_id, metric_name),
summary as (
  select user_id, metric_name,
         cast(printf('%.2f', lo) as double) as "min",
         cast(printf('%.2f', hi) as double) as "max",
         cast(printf('%.2f', mean) as double) as "avg",
         cast(printf('%.2f', last_value) as double) as latest,
         case when window_count < 2 then 'stable'
              when (second_mean - first_mean) / (first_mean + 1e-9) > 0.05 then 'increasing'
              when (second_mean - first_mean) / (first_mean + 1e-9) < -0.05 then 'decreasing'
              else 'stable' end as trend,
         window_count
  from stats)"""
    )


REQUESTS = """
requests as (
  select 'e' || event_id as request_id,
         'user_' || case when user_id < 10000 then lpad(cast(user_id as varchar), 4, '0')
                         else cast(user_id as varchar) end as user_id,
         case event_type when 'click' then 'heart_rate' when 'view' then 'steps'
              when 'purchase' then 'spo2' when 'signup' then 'spo2'
              else 'glucose' end as metric_name
  from events
  union all
  select 'c' || c_custkey,
         'user_' || case when c_custkey < 10000 then lpad(cast(c_custkey as varchar), 4, '0')
                         else cast(c_custkey as varchar) end,
         case c_mktsegment when 'BUILDING' then 'heart_rate' when 'AUTOMOBILE' then 'steps'
              when 'MACHINERY' then 'spo2' when 'HOUSEHOLD' then 'heart_rate'
              else 'glucose' end
  from customer)"""

BASELINE_TABLE = "baselines(metric_name, baseline) as (values {rows})".format(
    rows=", ".join(f"('{metric}', '{text}')" for metric, text in BASELINES.items())
)

SILVER_COLUMNS = (
    'user_id, "timestamp", heart_rate, steps, spo2, kafka_partition, kafka_offset, "date", '
    "is_anomaly"
)

ORACLES = {
    "gold_hourly": f"with {GOLD} select * from gold",
    "bronze_parse": f"""with {BRONZE}
        select user_id, "timestamp", heart_rate, steps, spo2, kafka_partition, kafka_offset
        from bronze""",
    "bronze_by_date": f"""with {BRONZE}
        select "date", count(*) as row_count, count(user_id) as parsed_count
        from bronze group by "date" """,
    "silver_clean": f"with {SILVER} select {SILVER_COLUMNS} from silver",
    "anomaly_rows": f"with {SILVER} select {SILVER_COLUMNS} from silver where is_anomaly",
    "event_encode": f"""with {READINGS}
        select user_id as key,
               '{{"user_id":"' || user_id || '","timestamp":"' || "timestamp" || '"'
               || coalesce(',"heart_rate":' || heart_rate, '')
               || ',"steps":' || steps || ',"spo2":' || spo2 || '}}' as value
        from readings""",
    "gold_batch_roundtrip": f"with {GOLD} select * from gold",
    "gold_hourly_stream": f"""with {GOLD}
        select * from gold
        where window_end <= (select max(event_at) - interval 15 minutes from silver)""",
    "gold_long": f"with {POINTS} select * from points",
    "gold_union": f"""with {POINTS}
        select user_id, avg_heart_rate, avg_spo2, total_steps, event_count, window_start,
               window_end, "date", null::varchar as metric_name, null::double as value
        from gold
        union all
        select user_id, null, null, null, null, null, "time", null, metric_name, value
        from points""",
    "recent_windows": f"""with {GOLD}
        select * from gold
        where window_end >= timestamp '2024-01-31 00:00:00' - interval 24 hours""",
    "user_history": f"""with {GOLD}
        select * from gold where user_id = 'user_0007' order by window_end""",
    "available_users": f"""with {GOLD}
        select distinct user_id from gold where user_id is not null order by user_id""",
    "user_metric_summary": f"with {summary()} select * from summary",
    "long_layout_summary": f"with {summary()} select * from summary",
    "latest_value": f"with {summary()} select user_id, metric_name, latest from summary",
    "metric_trend": f"""with {summary(24 * 31)}
        select user_id, metric_name, trend, window_count from summary""",
    "metric_catalog": f"""with {GOLD}
        select 'heart_rate' as metric_name, 'avg_heart_rate' as value_column,
               count(avg_heart_rate) as window_count from gold
        union all select 'steps', 'total_steps', count(total_steps) from gold
        union all select 'spo2', 'avg_spo2', count(avg_spo2) from gold""",
    "answer_requests": f"""with {REQUESTS}, {summary()},
        known as (select distinct user_id from gold where user_id is not null)
        select r.request_id, r.user_id, r.metric_name,
               case when r.metric_name not in ('heart_rate', 'steps', 'spo2')
                      then 'invalid_metric'
                    when k.user_id is null then 'unknown_user'
                    when s.user_id is null then 'no_recent_data'
                    else 'ok' end as status,
               s."min", s."max", s."avg", s.latest, s.trend, s.window_count
        from requests r
        left join known k on r.user_id = k.user_id
        left join summary s on r.user_id = s.user_id and r.metric_name = s.metric_name""",
    "baseline_lookup": f"""with {REQUESTS}, {BASELINE_TABLE}
        select r.*, coalesce(b.baseline, '{NO_BASELINE}') as baseline
        from requests r left join baselines b on r.metric_name = b.metric_name""",
    "advice_prompt": f"""with {summary()}, {BASELINE_TABLE}
        select s.*,
               'Metric ' || s.metric_name || ' of user ' || s.user_id
               || ' in the past 24 hours' || chr(10) || 'lowest: ' || s."min"
               || chr(10) || 'highest: ' || s."max" || chr(10) || 'mean: ' || s."avg"
               || chr(10) || 'most recent: ' || s.latest || chr(10) || 'trend: ' || s.trend
               || chr(10) || 'hourly windows: ' || s.window_count
               || chr(10) || 'Baseline: ' || b.baseline || chr(10)
               || 'Suggest three to five short, practical everyday habits that fit these '
               || 'numbers. Give general wellness advice and no diagnosis.' as prompt
        from summary s join baselines b on s.metric_name = b.metric_name""",
    "summary_rows": f"""with {summary()},
        numbers as (
          select user_id, metric_name, 1 as position, 'Minimum' as label, "min" as n from summary
          union all select user_id, metric_name, 2, 'Maximum', "max" from summary
          union all select user_id, metric_name, 3, 'Average', "avg" from summary
          union all select user_id, metric_name, 4, 'Latest', latest from summary)
        select user_id, metric_name, position, label,
               case when n = floor(n) then cast(cast(n as bigint) as varchar)
                    else printf('%.2f', n) end as value
        from numbers
        union all select user_id, metric_name, 5, 'Trend', trend from summary
        union all select user_id, metric_name, 6, 'window_count',
                         cast(window_count as varchar) from summary""",
    "user_label": f"""with {GOLD}
        select distinct user_id, 'Patient ' || substr(user_id, 6) as label
        from gold where user_id is not null""",
    "dq_checks": f"""with {GOLD},
        b as (select count(*) as n,
                     count(*) filter (where user_id is null or "timestamp" is null) as bad
              from bronze),
        s as (select count(*) as n,
                     count(*) filter (where heart_rate is null or steps is null
                                         or spo2 is null) as bad_null,
                     count(*) filter (where not heart_rate between 30 and 220) as bad_hr,
                     count(*) filter (where not spo2 between 70 and 100) as bad_spo2,
                     count(*) filter (where not steps >= 0) as bad_steps,
                     count(*) filter (where is_anomaly
                                        and not (heart_rate > 130 or spo2 < 92)) as bad_flag
              from silver),
        g as (select count(*) as n, count(distinct user_id) as users from gold),
        checks as (
          select 'bronze' as layer, 'schema' as "check", 8 as observed, 0 as violations
          union all select 'bronze', 'no_null_keys', n, bad from b
          union all select 'bronze', 'has_data', n, cast(n = 0 as bigint) from b
          union all select 'silver', 'schema', 6, 0
          union all select 'silver', 'no_nulls', n, bad_null from s
          union all select 'silver', 'range_heart_rate', n, bad_hr from s
          union all select 'silver', 'range_spo2', n, bad_spo2 from s
          union all select 'silver', 'range_steps', n, bad_steps from s
          union all select 'silver', 'anomaly_flag', n, bad_flag from s
          union all select 'gold', 'schema', 7, 0
          union all select 'gold', 'aggregation_exists', n, cast(n = 0 as bigint) from g
          union all select 'gold', 'user_coverage', users, cast(users = 0 as bigint) from g)
        select layer, "check", cast(observed as bigint) as observed,
               cast(violations as bigint) as violations,
               case when violations > 0 then 'failed' else 'passed' end as status
        from checks""",
    "layer_row_counts": f"""with {GOLD}
        select 'bronze' as layer, count(*) as row_count from bronze
        union all select 'silver', count(*) from silver
        union all select 'gold', count(*) from gold""",
}

ORACLES["three_layer_stream"] = f"""with {GOLD}
        select * replace (round(avg_heart_rate, 6) as avg_heart_rate, round(avg_spo2, 6) as avg_spo2)
        from gold
        where window_end <= (select max(event_at) - interval 15 minutes from silver)"""
ORACLES["recent_windows_layer"] = ORACLES["recent_windows"]
ORACLES["user_summary"] = ORACLES["answer_requests"] + "\n        where r.user_id = 'user_0007'"

# Events in the order of their arrival: a week a step, every seventh one step late. A window is
# closed, and its late rows dropped, when the steps before have seen 15 minutes beyond its end.
ARRIVED = (
    SILVER
    + """,
arrived as (
  select *, date_trunc('hour', event_at) + interval 1 hour as window_end,
         (day(event_at) - 1) // 7 + case when event_id % 7 = 3 then 1 else 0 end as step
  from silver),
seen as (select step, max(event_at) - interval 15 minutes as mark from arrived group by step),
marks as (
  select s.step, (select max(mark) from seen e where e.step < s.step) as closed_until,
         (select max(mark) from seen) as closed_at_last
  from seen s)"""
)

ORACLES["late_rows"] = f"""with {ARRIVED}
        select cast(step as bigint) as step, count(*) as read_rows,
               count(distinct case when window_end <= closed_until then (user_id, window_end) end) as late_groups
        from arrived join marks using (step) group by step"""
ORACLES["trigger_batches"] = f"""with {BRONZE},
        steps as (
          select b.*, (day(r.event_at) - 1) // 7 + case when event_id % 7 = 3 then 1 else 0 end as step
          from bronze b join readings r using (event_id))
        select cast(step as bigint) as step,
               count(*) filter (where heart_rate between 30 and 220 and spo2 between 70 and 100 and steps >= 0) as written_rows
        from steps group by step"""
ORACLES["late_gold"] = f"""with {ARRIVED}
        select user_id, round(avg(heart_rate), 6) as avg_heart_rate, round(avg(spo2), 6) as avg_spo2,
               cast(sum(steps) as bigint) as total_steps, count(*) as event_count,
               window_end - interval 1 hour as window_start, window_end,
               cast(window_end - interval 1 hour as date) as "date"
        from arrived join marks using (step)
        where (closed_until is null or window_end > closed_until) and window_end <= closed_at_last
        group by user_id, window_end"""
ORACLES["restart_no_dupes"] = ORACLES["three_layer_stream"]
ORACLES["corrupt_file_skip"] = ORACLES["silver_clean"]

HALF = "timestamp '2024-01-16 12:34:56'"
ORACLES["bronze_stamped"] = f"""with {BRONZE}
        select b.user_id, b."timestamp", b.heart_rate, b.steps, b.spo2, kafka_partition, kafka_offset,
               case when event_ts < {HALF} then timestamp '2024-02-01 00:00:00'
                    else event_ts + interval 5 minutes end as ingestion_timestamp, b."date"
        from bronze b join readings r using (event_id)"""

# Each half of the events is one batch of bronze and silver. Gold writes a window with the
# half after which it is closed.
BY_HALF = f"""{GOLD},
        sides as (
          select s.*, r.event_ts >= {HALF} as late from bronze s join readings r using (event_id)),
        kept as (
          select * from sides
          where heart_rate between 30 and 220 and spo2 between 70 and 100 and steps >= 0),
        ends as (
          select max(event_at) filter (where not late) - interval 15 minutes as first_end,
                 max(event_at) - interval 15 minutes as last_end from kept),
        closed as (
          select gold.*, window_end > first_end as late from gold, ends where window_end <= last_end)"""
ORACLES["file_count"] = f"""with {BY_HALF}
        select 'bronze' as layer, "date", count(distinct late) as files, count(*) as row_count from sides group by "date"
        union all select 'silver', "date", count(distinct late), count(*) from kept group by "date"
        union all select 'gold', "date", count(distinct late), count(*) from closed group by "date\""""
ORACLES["stream_row_counts"] = f"""with {BY_HALF}
        select 'bronze' as layer, cast(count(*) as bigint) as row_count from sides
        union all select 'silver', count(*) from kept
        union all select 'gold', count(*) from closed"""
ORACLES["layer_codecs"] = f"""with {GOLD}
        select 'bronze' as layer, 'zstd' as codec, count(distinct coalesce(cast("date" as varchar), '')) as files, count(*) as row_count from bronze
        union all select 'silver', 'gzip', count(distinct "date"), count(*) from silver
        union all select 'gold', 'snappy', count(distinct "date"), count(*) from gold"""
