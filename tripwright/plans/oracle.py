"""SQL with the same results as the registered queries, for an independent engine (DuckDB)."""

from __future__ import annotations

from tripwright.plans.derive import TABLES

# Relations the statements below are built on, each reading only earlier ones.
RELATIONS = {
    "raw_trips": """
        select event_id, value,
               cast(1 + user_id % 2 as bigint) as VendorID,
               case when k = 7 then null else ts end as tpep_pickup_datetime,
               make_timestamp(epoch_us(ts) + cast(floor(value * 60000000) as bigint))
                   as tpep_dropoff_datetime,
               cast(case when k % 5 = 0 then null else 1 + k % 5 end as double) as passenger_count,
               cast(case when k = 13 then null else k end as double) as trip_distance,
               cast(user_id % 30 as bigint) as PULocationID,
               cast(case when k = 17 then null else user_id % 25 end as bigint) as DOLocationID,
               cast(length(event_type) as bigint) as payment_type
        from (select *, cast(json_extract_string(props, '$.k') as int) as k from events) e""",
    "trips": """
        select * exclude (event_id, value) from (
            select *, value as fare_amount, value + 1.0e0 as total_amount from raw_trips
            union all
            select *, value, value + 1.0e0 from raw_trips where event_id % 10 = 0
            union all
            select *, 0.0e0 - value, 0.0e0 - (value + 1.0e0) from raw_trips
            where event_id % 20 = 5) u""",
    "zones": """
        select cast(n_nationkey as bigint) as LocationID,
               case when n_nationkey = 24 then null else r_name end as Borough,
               n_name as Zone
        from nation join region on n_regionkey = r_regionkey""",
    "complete": """
        select * from trips
        where tpep_pickup_datetime is not null and tpep_dropoff_datetime is not null
          and trip_distance is not null and not isnan(trip_distance)
          and PULocationID is not null and DOLocationID is not null""",
    "timed": """
        select *, tpep_pickup_datetime as pickup_ts, tpep_dropoff_datetime as dropoff_ts,
               date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) as trip_duration_s
        from complete""",
    "cleaned": """
        select distinct * from timed
        where trip_distance > 0 and trip_duration_s > 0 and trip_duration_s < 21600""",
    "cleaned_keyed": """
        select * from cleaned
        qualify row_number() over (
            partition by tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,
                         trip_distance
            order by total_amount desc nulls last, fare_amount desc nulls last,
                     VendorID nulls last, payment_type nulls last,
                     passenger_count nulls last) = 1""",
    "joined": """
        select c.*, z.Borough, z.Zone
        from cleaned c join zones z on c.PULocationID = z.LocationID""",
    "joined_keyed": """
        select c.*, z.Borough, z.Zone
        from cleaned_keyed c join zones z on c.PULocationID = z.LocationID
        where z.Borough is not null""",
}


def _add_variants() -> None:
    for suffix in ("", "_keyed"):
        RELATIONS[f"enriched{suffix}"] = f"""
        select pickup_ts, dropoff_ts, trip_distance, trip_duration_s, PULocationID, Borough, Zone,
               trip_distance / (trip_duration_s / cast(3600.0 as double)) as avg_speed_mph,
               cast(hour(pickup_ts) as int) as pickup_hour
        from joined{suffix}"""
    for suffix in ("", "_keyed"):
        RELATIONS[f"exact{suffix}"] = f"""
        select pickup_hour, Borough, avg(avg_speed_mph) as mean_speed_mph,
               count(*) as trip_count
        from enriched{suffix} group by 1, 2"""
        RELATIONS[f"agg{suffix}"] = f"""
        select * replace (round(mean_speed_mph, 6) as mean_speed_mph) from exact{suffix}"""
    for suffix in ("", "_keyed"):
        RELATIONS[f"funnel{suffix}"] = f"""
        select 'input_rows' as stage, count(*) as row_count from trips
        union all select 'cleaned_rows', count(*) from cleaned{suffix}
        union all select 'joined_rows', count(*) from joined{suffix}
        union all select 'agg_rows', count(*) from agg{suffix}"""


_add_variants()

RELATIONS["matched"] = """
        select coalesce(a.pickup_hour, b.pickup_hour) as pickup_hour,
               coalesce(a.Borough, b.Borough) as Borough,
               a.trip_count as left_count, b.trip_count as right_count,
               a.mean_speed_mph as left_mean, b.mean_speed_mph as right_mean,
               case when a.trip_count is null then 'missing_left'
                    when b.trip_count is null then 'missing_right'
                    when a.trip_count <> b.trip_count then 'count_diff'
                    when a.mean_speed_mph is null and b.mean_speed_mph is null then 'ok'
                    when a.mean_speed_mph is null or b.mean_speed_mph is null then 'mean_diff'
                    when isnan(a.mean_speed_mph) <> isnan(b.mean_speed_mph) then 'mean_diff'
                    when isnan(a.mean_speed_mph) then 'ok'
                    when abs(a.mean_speed_mph - b.mean_speed_mph) > 0.01 then 'mean_diff'
                    else 'ok' end as status
        from exact a full outer join exact_keyed b
          on a.pickup_hour = b.pickup_hour and a.Borough is not distinct from b.Borough"""
RELATIONS["matched_counts"] = """
        select count(*) as group_count,
               count(*) filter (where status = 'missing_left') as missing_left_groups,
               count(*) filter (where status = 'missing_right') as missing_right_groups,
               count(*) filter (where status = 'count_diff') as count_diff_groups,
               count(*) filter (where status = 'mean_diff') as mean_diff_groups,
               count(*) filter (where status = 'ok') as ok_groups,
               count(*) filter (where left_count <> right_count) as differing_counts,
               count(*) filter (where abs(left_mean - right_mean) > 0.01)
                   as means_out_of_tolerance,
               round(max(abs(left_mean - right_mean)), 6) as largest_mean_diff
        from matched"""
RELATIONS["phase_seconds"] = """
        select case when user_id % 2 = 0 then 'left' else 'right' end as variant,
               unnest([event_type, 'total_s']) as phase, value as seconds
        from events"""


def with_relations(select: str) -> str:
    """The statement with every relation before it; the engine drops those it does not use."""
    shared = ",\n".join(f"{name} as ({body})" for name, body in RELATIONS.items())
    return f"with {shared}\n{select}"


def _filled(side: str, source: str) -> str:
    columns = ("pickup_hour", "Borough", "mean_speed_mph", "trip_count")
    return " union all ".join(
        f"select '{c}' as column_name, count({c}) as {side}_filled from {source}" for c in columns
    )


def _peaks() -> str:
    load = "round(value - 100 * floor(value / 100), 1)"
    return f"""
        select event_type as label, round(max({load}), 6) as peak_cpu,
               cast(max(1000 + user_id) as double) as peak_mem_mb
        from events group by 1"""


STATEMENTS = {
    "scan_normalized": "select * from trips",
    "scan_directory": "select * from events",
    "scan_csv_dimension": "select * from zones",
    "sink_roundtrip": "select * from enriched",
    "sink_summary_roundtrip": "select * from agg",
    "sink_append": "select * from enriched",
    "sink_published": "select * from enriched",
    "source_volume": " union all ".join(
        f"select '{t}' as table_name, cast(1 as bigint) as files, count(*) as row_count from {t}"
        for t in TABLES
    ),
    "project_contract": """
        select cast(o_orderkey as int) as O_OrderKey, cast(o_custkey as double) as O_CustKey,
               o_orderdate as O_OrderDate, o_totalprice as O_TotalPrice,
               o_orderstatus as O_OrderStatus, cast(null as varchar) as O_Clerk
        from orders""",
    "union_by_name": "select * from lineitem",
    "filter_required": "select * from complete",
    "dedup_full_row": "select distinct * from complete",
    "derive_duration": "select *, cast(hour(pickup_ts) as int) as pickup_hour from timed",
    "filter_ranges": "select * from cleaned",
    "dedup_by_keys": "select * from cleaned_keyed",
    "clean_keyed": "select * from cleaned_keyed",
    "join_zone_inner": "select * from joined",
    "join_zone_merge": "select * from joined",
    "join_lookup": "select * from joined_keyed",
    **dict.fromkeys(
        ("speed_native", "speed_udf_row", "speed_udf_pandas"),
        """
        select *, case when trip_duration_s > 0
                       then trip_distance / (trip_duration_s / cast(3600.0 as double))
                  end as avg_speed_mph
        from cleaned""",
    ),
    "trips_enriched": "select * from enriched",
    "trips_enriched_keyed": "select * from enriched_keyed",
    "speed_by_hour_borough": "select * from agg",
    "speed_by_hour_borough_keyed": "select * from agg_keyed",
    "pipeline_funnel": "select * from funnel",
    "reconcile_row_counts": """
        select stage, a.row_count as left_rows, b.row_count as right_rows,
               a.row_count = b.row_count as is_equal
        from funnel a join funnel_keyed b using (stage)""",
    "reconcile_groups": """
        select pickup_hour, Borough, left_count, right_count, status from matched""",
    "reconcile_summary": "select * from matched_counts",
    "reconcile_key_diff": """
        select 'left' as side, * from (
            select pickup_hour, Borough from agg except select pickup_hour, Borough from agg_keyed)
        union all
        select 'right' as side, * from (
            select pickup_hour, Borough from agg_keyed
            except select pickup_hour, Borough from agg)""",
    "reconcile_schema": f"""
        select column_name, true as in_left, true as in_right, left_filled, right_filled
        from ({_filled("left", "agg")}) l join ({_filled("right", "agg_keyed")}) r
        using (column_name)""",
    "reconcile_report": """
        select *, failures = 0 as ok from (
            select 'columns_present' as "check", cast(0 as bigint) as failures
            union all
            select 'repeated_keys', count(*) from (
                select 1 from exact group by pickup_hour, Borough having count(*) > 1
                union all
                select 1 from exact_keyed group by pickup_hour, Borough having count(*) > 1)
            union all
            select 'group_counts', abs((select count(*) from exact) - (select count(*) from exact_keyed))
            union all
            select 'row_counts', count(*) filter (where a.row_count <> b.row_count)
            from funnel a join funnel_keyed b using (stage)
            union all
            select 'group_keys', missing_left_groups + missing_right_groups from matched_counts
            union all select 'trip_counts', differing_counts from matched_counts
            union all select 'mean_speeds', means_out_of_tolerance from matched_counts) c""",
    "run_metrics_long": """
        select 'run-' || user_id as run_id,
               case when user_id % 2 = 0 then 'left' else 'right' end as variant,
               event_type as phase, round(sum(value), 6) as seconds
        from events group by user_id, event_type
        union all
        select 'run-' || user_id, case when user_id % 2 = 0 then 'left' else 'right' end,
               'total_s', round(sum(value) + 2.5, 6)
        from events group by user_id""",
    "run_metrics_compare": """
        select case when phase = 'total_s' then 'Total' else phase end as phase,
               round(avg(seconds) filter (where variant = 'left'), 6) as left_s,
               round(avg(seconds) filter (where variant = 'right'), 6) as right_s,
               round(avg(seconds) filter (where variant = 'left')
                     / avg(seconds) filter (where variant = 'right'), 6) as ratio
        from phase_seconds group by 1""",
    "run_metrics_repeat": """
        select variant, phase, round(quantile_cont(seconds, 0.5), 6) as median_s,
               round(quantile_cont(seconds, 0.75) - quantile_cont(seconds, 0.25), 6) as iqr_s
        from phase_seconds group by 1, 2""",
    "resource_peaks": _peaks(),
}
STATEMENTS["sink_comparison"] = STATEMENTS["run_metrics_compare"]


def oracle_sql() -> dict[str, str]:
    return {name: with_relations(select) for name, select in STATEMENTS.items()}
