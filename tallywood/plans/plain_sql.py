r"""Plain SQL for every query of :mod:`tallywood.plans.checked`.

Written for DuckDB over the same tables, independently of the DataFrame code:
other functions, one flat ``parsed`` relation, window functions where the
DataFrames group twice.  In these strings a backslash is a plain backslash.
"""

from __future__ import annotations

_LOG = r"""
WITH log_lines AS (
  SELECT event_id,
    CASE WHEN event_type = 'signup' THEN '    env CONTINUED ' || user_id
    ELSE strftime(ts, '%y/%m/%d %H:%M:%S') || CASE
      WHEN event_type = 'error' THEN
        ' ERROR executor.Executor: Exception in task ' || (event_id % 7) || '.0 in stage '
        || (event_id % 5) || '.0 (TID ' || (event_id // 2) || ') after INFO'
      WHEN event_type = 'click' AND event_id % 2 = 0 THEN
        ' INFO executor.Executor: Running task ' || (event_id % 7) || '.0 in stage '
        || (event_id % 5) || '.0 (TID ' || (user_id // 2) || ')'
      WHEN event_type = 'click' THEN
        ' INFO executor.Executor: Finished task ' || (event_id % 7) || '.0 in stage '
        || (event_id % 5) || '.0 (TID ' || (user_id // 2) || '). ' || (event_id % 3000)
        || ' bytes result sent to driver'
      WHEN event_type = 'view' AND event_id % 4 = 0 THEN
        ' INFO python.PythonRunner: Times: total = ' || (event_id % 900 + 100)
        || ', boot = ' || (event_id % 50 - 5) || ', init = ' || (event_id % 30)
        || ', finish = ' || (event_id % 900 + 20)
      WHEN event_type = 'view' AND event_id % 4 = 1 THEN
        ' INFO rdd.HadoopRDD: Input split: hdfs://10.0.0.1:9000/in/file' || (event_id % 9)
        || '.txt:' || (event_id * 1000) || '+' || (event_id % 777 + 1)
      WHEN event_type = 'view' AND event_id % 20 = 2 THEN
        ' INFO storage.MemoryStore: MemoryStore started with capacity '
        || (event_id % 12 + 1) || '.5 GB'
      WHEN event_type = 'view' AND event_id % 4 = 2 THEN
        ' INFO storage.MemoryStore: Block rdd_' || (event_id % 40) || '_' || (event_id % 8)
        || ' stored as bytes in memory (estimated size ' || (event_id % 90 + 1) || '.5 '
        || CASE WHEN event_id % 3 = 0 THEN 'KB' ELSE 'MB' END
        || ', free ' || (event_id % 12 + 1) || '.0 GB)'
      WHEN event_type = 'view' THEN
        ' DEBUG broadcast.TorrentBroadcast: Started reading broadcast variable '
        || (event_id % 25)
      WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN
        ' WARN YarnAllocator: Will request ' || (event_id % 16 + 1)
        || ' executor containers, each with ' || (event_id % 5 + 1) || ' cores and '
        || ((event_id % 4 + 1) * 1024) || ' MB memory including '
        || ((event_id % 4 + 1) * 128) || ' MB overhead'
      WHEN event_type = 'purchase' THEN
        ' INFO YarnAllocator: Container request (host: '
        || CASE WHEN event_id % 3 = 0 THEN 'Any' ELSE 'mesos-slave-' || (event_id % 11) END
        || ', capability: <memory:' || ((event_id % 4 + 1) * 1024) || ', vCores:'
        || (event_id % 5 + 1) || '>)'
      END
    END AS value,
    'file:/logs/application_' || (1485248649253 + user_id % 6) || '_'
    || lpad(user_id::varchar, 4, '0') || '/container_' || (1485248649253 + user_id % 6)
    || '_' || lpad(user_id::varchar, 4, '0') || '_01_'
    || lpad((event_id % 4 + 1)::varchar, 6, '0') || '.log' AS file_path
  FROM events
), parsed AS (
  SELECT event_id, value, file_path,
    nullif(regexp_extract(value, '(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})', 1), '') AS stamp_text,
    try_strptime(regexp_extract(value, '^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})', 1),
                 '%y/%m/%d %H:%M:%S') AS ts,
    nullif(regexp_extract(value, '(INFO|WARN|ERROR|DEBUG)', 1), '') AS log_level,
    nullif(regexp_extract(value, '(INFO|WARN|ERROR|DEBUG)\s+([^:]+):', 2), '') AS component,
    nullif(regexp_extract(file_path, '(application_\d+_\d+)', 1), '') AS application_id,
    nullif(regexp_extract(file_path, 'application_(\d+)_\d+', 1), '') AS cluster_id,
    nullif(regexp_extract(file_path, 'application_\d+_(\d+)', 1), '') AS app_number,
    nullif(regexp_extract(file_path, '(container_\d+_\d+_\d+_\d+)', 1), '') AS container_id,
    regexp_extract(file_path, '(container_\d+_\d+_\d+_\d+)', 1) LIKE '%000001' AS is_app_master
  FROM log_lines
)"""

_TIMELINE = _LOG + r""", timeline AS (
  SELECT application_id, cluster_id, app_number, min(ts) AS app_start, max(ts) AS app_end
  FROM parsed
  WHERE application_id IS NOT NULL AND ts IS NOT NULL
  GROUP BY ALL
), clusters AS (
  SELECT cluster_id, count(DISTINCT application_id) AS num_applications,
         min(app_start) AS cluster_first_app, max(app_end) AS cluster_last_app
  FROM timeline GROUP BY cluster_id
), busiest AS (
  SELECT cluster_id FROM clusters ORDER BY num_applications DESC, cluster_id LIMIT 1
), spans AS (
  SELECT application_id, cluster_id, date_sub('second', app_start, app_end) AS duration_sec,
         count(*) OVER (PARTITION BY cluster_id) AS n,
         min(date_sub('second', app_start, app_end)) OVER (PARTITION BY cluster_id) AS low,
         max(date_sub('second', app_start, app_end)) OVER (PARTITION BY cluster_id) AS high
  FROM timeline
)"""

_HISTOGRAM = r"""
SELECT cluster_id, bin, low + bin * ((high - low) / 50) AS bin_start,
       low + (bin + 1) * ((high - low) / 50) AS bin_end, count(*) AS num_applications
FROM (
  SELECT cluster_id, low, high,
         CASE WHEN high > low
              THEN least(cast(floor((duration_sec - low) * 50 / (high - low)) AS integer), 49)
              ELSE 0 END AS bin
  FROM spans
  {where}
)
GROUP BY cluster_id, bin, low, high"""

_DENSITY = r"""
, shape AS (
  SELECT cluster_id, count(*) AS n, min(duration_sec) AS low, max(duration_sec) AS high,
         pow(count(*), -0.2) * stddev_samp(duration_sec) AS bandwidth
  FROM spans
  {where}
  GROUP BY cluster_id
  HAVING stddev_samp(duration_sec) > 0
), grid AS (
  SELECT cluster_id, n, bandwidth, cast(point AS integer) AS point,
         low + point * ((high - low) / 199) AS spot
  FROM shape, range(0, 200) AS steps(point)
)
SELECT cluster_id, point, spot AS duration_sec,
       round(sum(exp(-0.5 * pow((spot - spans.duration_sec) / bandwidth, 2)))
             / (any_value(grid.n) * any_value(bandwidth) * sqrt(2 * pi())), 12) AS density
FROM grid JOIN spans USING (cluster_id)
GROUP BY cluster_id, point, spot"""

_ONLY_BUSIEST = "WHERE cluster_id IN (SELECT cluster_id FROM busiest)"

_TASKS = _LOG + r""", tasks AS (
  SELECT application_id, stage, tid,
         min(ts) FILTER (event = 'Running') AS task_start,
         max(ts) FILTER (event = 'Finished') AS task_end,
         max(result_bytes) AS result_bytes
  FROM (
    SELECT application_id, ts, regexp_extract(value, '(Running|Finished) task', 1) AS event,
           cast(regexp_extract(value, 'in stage (\d+)\.', 1) AS bigint) AS stage,
           cast(regexp_extract(value, '\(TID (\d+)\)', 1) AS bigint) AS tid,
           try_cast(nullif(regexp_extract(value, '(\d+) bytes result sent to driver', 1), '')
                    AS bigint) AS result_bytes
    FROM parsed
    WHERE regexp_matches(value, '(Running|Finished) task \d+\.\d+ in stage \d+\.\d+ \(TID \d+\)')
  )
  GROUP BY application_id, stage, tid
), timed AS (
  SELECT *, coalesce(task_end < task_start, false) AS out_of_order,
         CASE WHEN task_start <= task_end THEN date_sub('second', task_start, task_end) END
           AS seconds
  FROM tasks
)"""

_DAILY = r"""
WITH daily AS (
  SELECT cast(year(l_shipdate) AS integer) AS dt_year,
         cast(month(l_shipdate) AS integer) AS dt_month,
         cast(day(l_shipdate) AS integer) AS dt_day,
         count(*) AS num_trips,
         avg(l_quantity) AS mean_trip_distance,
         max(l_tax) AS max_mta_tax,
         quantile_disc(l_extendedprice, 0.95) AS q95_fare_amount,
         min(l_discount) AS min_tip_amount,
         cast(ceil(avg(l_quantity)) AS bigint) AS mean_passenger_count
  FROM lineitem
  WHERE year(l_shipdate) = 1998
  GROUP BY ALL
)"""

_FILES = r"""
SELECT application_id, count(*) AS num_files, cast(sum(bytes) AS bigint) AS total_bytes
FROM (
  SELECT application_id, file_path, sum(strlen(value) + 1) AS bytes
  FROM parsed GROUP BY application_id, file_path
)
GROUP BY application_id"""

_SIZE = (
    "cast(round(cast({number} AS double) * CASE {unit} WHEN 'B' THEN 1 WHEN 'KB' THEN 1024"
    " WHEN 'MB' THEN 1048576 WHEN 'GB' THEN 1073741824 END) AS bigint)"
)


def _size(pattern: str, group: int) -> str:
    number = f"regexp_extract(value, '{pattern}', {group})"
    unit = f"regexp_extract(value, '{pattern}', {group + 1})"
    return _SIZE.format(number=number, unit=unit)


_BLOCK = (
    r"Block (\S+) stored as bytes in memory \(estimated size ([\d.]+) (B|KB|MB|GB),"
    r" free ([\d.]+) (B|KB|MB|GB)\)"
)
_CAPACITY = r"MemoryStore started with capacity ([\d.]+) (B|KB|MB|GB)"
_BLOCKS = f"""
SELECT application_id, container_id, ts, regexp_extract(value, '{_BLOCK}', 1) AS block,
       {_size(_BLOCK, 2)} AS block_bytes, {_size(_BLOCK, 4)} AS free_bytes
FROM parsed WHERE regexp_matches(value, '{_BLOCK}')"""

_REQUEST = (
    r"Will request (\d+) executor containers, each with (\d+) cores and (\d+) MB memory"
    r"(?: including (\d+) MB overhead)?"
)
_REQUESTS = f"""
SELECT application_id, container_id, ts,
       try_cast(regexp_extract(value, '{_REQUEST}', 1) AS bigint) AS containers,
       try_cast(regexp_extract(value, '{_REQUEST}', 2) AS bigint) AS cores,
       try_cast(regexp_extract(value, '{_REQUEST}', 3) AS bigint) AS memory_mb,
       try_cast(regexp_extract(value, '{_REQUEST}', 4) AS bigint) AS overhead_mb
FROM parsed WHERE regexp_matches(value, '{_REQUEST}')"""

_TIMES = r"Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)"
_PYTHON = f"""
SELECT application_id, container_id, ts,
       try_cast(regexp_extract(value, '{_TIMES}', 1) AS bigint) AS total_ms,
       try_cast(regexp_extract(value, '{_TIMES}', 2) AS bigint) AS boot_ms,
       try_cast(regexp_extract(value, '{_TIMES}', 3) AS bigint) AS init_ms,
       try_cast(regexp_extract(value, '{_TIMES}', 4) AS bigint) AS finish_ms
FROM parsed WHERE regexp_matches(value, '{_TIMES}')"""

_LEVELS = r"""
SELECT log_level, count(*) AS count, count(*) / sum(count(*)) OVER () * 100 AS percent
FROM parsed WHERE log_level IS NOT NULL GROUP BY log_level"""

ORACLES: dict[str, str] = {
    # log levels
    "log_parse": _LOG + " SELECT * FROM parsed",
    "level_counts": _LOG + _LEVELS,
    "log_totals": _LOG + r"""
SELECT count(*) AS total_lines, count(log_level) AS lines_with_level,
       count(DISTINCT log_level) AS distinct_levels
FROM parsed""",
    "log_sample": _LOG + r"""
SELECT value AS log_entry, log_level FROM parsed WHERE log_level IS NOT NULL
ORDER BY md5(concat('42|', event_id, '|', value)) LIMIT 10""",
    "level_report_lines": _LOG + ", levels AS (" + _LEVELS + r""")
SELECT cast(line_no AS integer) AS line_no, line FROM (
  SELECT 0 AS line_no, 'Total log lines processed: ' || count(*) AS line FROM parsed
  UNION ALL SELECT 1, 'Total lines with log levels: ' || count(log_level) FROM parsed
  UNION ALL SELECT 2, 'Unique log levels found: ' || count(DISTINCT log_level) FROM parsed
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Log level distribution:'
  UNION ALL SELECT 4 + row_number() OVER (ORDER BY count DESC, log_level),
                   printf('  %-5s: %10d (%6.2f%%)', log_level, count, percent) FROM levels
)""",
    "level_occurrences": _LOG + r"""
SELECT log_level, count(*) AS occurrences FROM (
  SELECT unnest(regexp_extract_all(value, '(INFO|WARN|ERROR|DEBUG)')) AS log_level FROM log_lines
) GROUP BY log_level""",
    "error_lines": _LOG + r"""
SELECT application_id, container_id, ts, value FROM parsed WHERE log_level = 'ERROR'""",
    "error_lines_literal": _LOG + r"""
SELECT application_id, container_id, ts, value FROM parsed WHERE value LIKE '%ERROR%'""",
    # applications and clusters
    "file_profile": _LOG + r"""
SELECT file_path, count(*) AS num_lines, cast(sum(strlen(value) + 1) AS bigint) AS bytes,
       count(*) FILTER (log_level = 'INFO') AS info_lines,
       count(*) FILTER (log_level = 'WARN') AS warn_lines,
       count(*) FILTER (log_level = 'ERROR') AS error_lines,
       count(*) FILTER (log_level = 'DEBUG') AS debug_lines,
       min(ts) AS first_time, max(ts) AS last_time
FROM parsed GROUP BY file_path""",
    "levels_from_files": _LOG + r"""
SELECT log_level, count(*) AS num_lines, count(log_level) AS count
FROM parsed GROUP BY log_level""",
    "app_timeline": _TIMELINE + " SELECT * FROM timeline",
    "cluster_summary": _TIMELINE + " SELECT * FROM clusters",
    "usage_totals": _TIMELINE + r"""
SELECT count(DISTINCT cluster_id) AS total_clusters,
       count(DISTINCT application_id) AS total_applications,
       count(DISTINCT application_id) / count(DISTINCT cluster_id) AS avg_applications
FROM timeline""",
    "usage_report_lines": _TIMELINE + r"""
SELECT cast(line_no AS integer) AS line_no, line FROM (
  SELECT 0 AS line_no, 'Total unique clusters: ' || count(DISTINCT cluster_id) AS line FROM timeline
  UNION ALL SELECT 1, 'Total applications: ' || count(*) FROM timeline
  UNION ALL SELECT 2, printf('Average applications per cluster: %.2f',
                             count(*) / count(DISTINCT cluster_id)) FROM timeline
  UNION ALL SELECT 3, ''
  UNION ALL SELECT 4, 'Most heavily used clusters:'
  UNION ALL SELECT 4 + place, printf('  Cluster %s: %d applications', cluster_id, num_applications)
            FROM (SELECT *, row_number() OVER (ORDER BY num_applications DESC, cluster_id) AS place
                  FROM clusters)
            WHERE place <= 10
)""",
    "cluster_start": _TIMELINE + r"""
SELECT cluster_id, epoch_ms(cast(cluster_id AS bigint)) AS cluster_start FROM clusters""",
    "container_roles": _LOG + r"""
SELECT application_id, count(*) AS num_lines, count(DISTINCT container_id) AS num_containers,
       count(*) FILTER (is_app_master) AS master_lines,
       count(*) FILTER (NOT is_app_master) AS executor_lines
FROM parsed GROUP BY application_id""",
    "error_rates": _LOG + r"""
SELECT application_id, count(*) AS num_lines,
       count(*) FILTER (log_level = 'ERROR') AS error_lines,
       count(*) FILTER (log_level = 'ERROR') / count(*) AS error_share
FROM parsed GROUP BY application_id""",
    "container_error_rates": _LOG + r"""
SELECT container_id, count(*) AS num_lines,
       count(*) FILTER (log_level = 'ERROR') AS error_lines,
       count(*) FILTER (log_level = 'ERROR') / count(*) AS error_share
FROM parsed GROUP BY container_id""",
    "application_inventory": _LOG + _FILES,
    "inventory_totals": _LOG + r"""
SELECT count(*) AS num_applications, cast(sum(num_files) AS bigint) AS num_files,
       cast(sum(total_bytes) AS bigint) AS total_bytes,
       sum(num_files) / count(*) AS avg_files,
       min(total_bytes) AS min_bytes, max(total_bytes) AS max_bytes,
       sum(total_bytes) / count(*) AS avg_bytes
FROM (""" + _FILES + ")",
    "largest_applications": _LOG + _FILES + " ORDER BY num_files DESC, application_id LIMIT 5",
    # durations
    "app_durations": _TIMELINE + r"""
SELECT application_id, cluster_id, duration_sec, n FROM spans""",
    "top_cluster_durations": _TIMELINE + r"""
SELECT application_id, cluster_id, duration_sec, n FROM spans """ + _ONLY_BUSIEST,
    "duration_histogram": _TIMELINE + _HISTOGRAM.format(where=_ONLY_BUSIEST),
    "duration_histogram_by_cluster": _TIMELINE + _HISTOGRAM.format(where=""),
    "duration_density": _TIMELINE + _DENSITY.format(where=_ONLY_BUSIEST),
    "duration_density_by_cluster": _TIMELINE + _DENSITY.format(where=""),
    # known messages
    "component_counts": _LOG + r"""
SELECT component, count(*) AS num_lines FROM parsed GROUP BY component""",
    "top_components": _LOG + r"""
SELECT component, count(*) AS num_lines FROM parsed GROUP BY component
ORDER BY num_lines DESC, component NULLS LAST LIMIT 20""",
    "resource_requests": _LOG + _REQUESTS,
    "requested_resources": _LOG + r"""
SELECT application_id, count(*) AS num_requests, cast(sum(containers) AS bigint) AS containers,
       cast(sum(containers * cores) AS bigint) AS cores,
       cast(sum(containers * memory_mb) AS bigint) AS memory_mb,
       max(cores) AS max_cores, max(memory_mb) AS max_memory_mb,
       max(overhead_mb) AS max_overhead_mb
FROM (""" + _REQUESTS + r""") GROUP BY application_id""",
    "container_requests": _LOG + r"""
SELECT application_id, container_id, ts,
       regexp_extract(value, 'host: ([^,]+),', 1) AS host,
       cast(regexp_extract(value, '<memory:(\d+),', 1) AS bigint) AS memory_mb,
       cast(regexp_extract(value, 'vCores:(\d+)>', 1) AS bigint) AS vcores
FROM parsed WHERE value LIKE '%Container request (host: %, capability: <memory:%'""",
    "task_events": _LOG + r"""
SELECT application_id, container_id, ts,
       regexp_extract(value, '(Running|Finished) task', 1) AS event,
       cast(regexp_extract(value, 'task (\d+)\.', 1) AS bigint) AS task,
       cast(regexp_extract(value, 'task \d+\.(\d+)', 1) AS bigint) AS attempt,
       cast(regexp_extract(value, 'in stage (\d+)\.', 1) AS bigint) AS stage,
       cast(regexp_extract(value, 'in stage \d+\.(\d+)', 1) AS bigint) AS stage_attempt,
       cast(regexp_extract(value, '\(TID (\d+)\)', 1) AS bigint) AS tid,
       try_cast(nullif(regexp_extract(value, '(\d+) bytes result', 1), '') AS bigint)
         AS result_bytes
FROM parsed
WHERE regexp_matches(value, '(Running|Finished) task \d+\.\d+ in stage \d+\.\d+ \(TID \d+\)')""",
    "task_times": _TASKS + " SELECT * FROM timed",
    "app_task_times": _TASKS + r"""
SELECT application_id, count(*) AS num_tasks,
       count(*) FILTER (task_end IS NULL) AS num_unfinished,
       count(*) FILTER (out_of_order) AS num_out_of_order,
       count(seconds) AS num_timed,
       sum(seconds) / nullif(count(seconds), 0) AS avg_seconds,
       max(seconds) AS max_seconds, cast(sum(result_bytes) AS bigint) AS result_bytes
FROM timed GROUP BY application_id""",
    "stage_skew": _TASKS + r"""
SELECT *, max_seconds / nullif(median_seconds, 0) AS skew FROM (
  SELECT application_id, stage, count(*) AS num_tasks,
         count(*) FILTER (task_end IS NULL) AS num_unfinished,
         count(*) FILTER (out_of_order) AS num_out_of_order,
         count(seconds) AS num_timed,
         percentile_disc(0.5) WITHIN GROUP (ORDER BY seconds) AS median_seconds,
         percentile_disc(0.95) WITHIN GROUP (ORDER BY seconds) AS p95_seconds,
         max(seconds) AS max_seconds
  FROM timed GROUP BY application_id, stage
)""",
    "python_times": _LOG + _PYTHON,
    "app_python_times": _LOG + r"""
SELECT application_id, count(*) AS num_reports,
       sum(total_ms) / count(total_ms) AS avg_total_ms,
       sum(boot_ms) / count(boot_ms) AS avg_boot_ms,
       sum(init_ms) / count(init_ms) AS avg_init_ms,
       sum(finish_ms) / count(finish_ms) AS avg_finish_ms
FROM (""" + _PYTHON + ") GROUP BY application_id",
    "input_splits": _LOG + r"""
SELECT application_id, container_id, ts,
       regexp_extract(value, 'Input split: (\S+):\d+\+\d+', 1) AS input_path,
       cast(regexp_extract(value, ':(\d+)\+\d+', 1) AS bigint) AS "offset",
       cast(regexp_extract(value, ':\d+\+(\d+)', 1) AS bigint) AS length
FROM parsed WHERE regexp_matches(value, 'Input split: \S+:\d+\+\d+')""",
    "memory_blocks": _LOG + _BLOCKS,
    "memory_capacities": _LOG + f"""
SELECT application_id, container_id, ts, {_size(_CAPACITY, 1)} AS capacity_bytes
FROM parsed WHERE regexp_matches(value, '{_CAPACITY}')""",
    "cached_bytes": _LOG + r"""
SELECT application_id, count(*) AS num_blocks, cast(sum(block_bytes) AS bigint) AS total_bytes,
       max(block_bytes) AS max_bytes, min(free_bytes) AS min_free_bytes
FROM (""" + _BLOCKS + ") GROUP BY application_id",
    "broadcast_reads": _LOG + r"""
SELECT application_id, container_id, ts,
       cast(regexp_extract(value, 'broadcast variable (\d+)', 1) AS bigint) AS broadcast_id
FROM parsed WHERE regexp_matches(value, 'Started reading broadcast variable \d+')""",
    "host_containers": _LOG + r"""
SELECT host, count(DISTINCT container_id) AS num_containers, count(*) AS num_mentions
FROM (SELECT unnest(regexp_extract_all(value, 'mesos-slave-\w+')) AS host, container_id FROM parsed)
GROUP BY host""",
    "multiline_records": _LOG + r"""
SELECT file_path, coalesce(head, line) AS record, coalesce((line - head) // 3, 0) AS part,
       count(*) AS num_lines, string_agg(value, chr(10) ORDER BY line) AS text
FROM (
  SELECT *, max(CASE WHEN regexp_matches(value, '^\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}')
                     THEN line END)
              OVER (PARTITION BY file_path ORDER BY line) AS head
  FROM (
    SELECT file_path, value, row_number() OVER (PARTITION BY file_path ORDER BY event_id) AS line
    FROM log_lines
  )
)
GROUP BY file_path, coalesce(head, line), coalesce((line - head) // 3, 0)""",
    # files
    "level_counts_from_csv": _LOG + r"""
SELECT log_level, count(*) AS count FROM parsed WHERE log_level IS NOT NULL GROUP BY log_level""",
    "quoted_csv_round_trip": r"""
SELECT event_id, props || chr(10) || '"",\' || event_type || CASE WHEN event_id % 2 = 0 THEN '\' ELSE '"' END AS log_entry
FROM events""",
    "month_folders": r"""
SELECT cast(month(l_shipdate) AS integer) AS month, count(*) AS num_rows, sum(l_quantity) AS quantity
FROM lineitem WHERE l_shipdate >= '1998-01-01' AND l_shipdate < '1998-04-01' GROUP BY 1""",
    "column_profile": r"""
WITH described AS (SELECT column_index - 1 AS position, column_name, data_type
                   FROM duckdb_columns() WHERE table_name = 'events'),
filled AS (SELECT column_name, count(*) AS filled FROM (UNPIVOT (SELECT COLUMNS(*)::varchar FROM events) ON *
                  INTO NAME column_name VALUE v) GROUP BY column_name)
SELECT cast(position AS integer) AS position, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
                      WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' END AS column_type,
       (SELECT count(*) FROM events) AS num_rows,
       (SELECT count(*) FROM events) - coalesce(filled, 0) AS num_nulls
FROM described LEFT JOIN filled USING (column_name)""",
    # trips
    "daily_summary": _DAILY + " SELECT * FROM daily",
    "daily_rollup": _DAILY + r"""
SELECT count(*) AS num_days, cast(sum(num_trips) AS bigint) AS total_trips,
       sum(num_trips) / count(*) AS mean_daily_trips,
       min(make_date(dt_year, dt_month, dt_day)) AS first_day,
       max(make_date(dt_year, dt_month, dt_day)) AS last_day
FROM daily""",
    "top_days": _DAILY + r"""
SELECT * FROM daily ORDER BY dt_year DESC, dt_month DESC, dt_day DESC LIMIT 20""",
    "trip_totals": r"""
SELECT count(*) AS trips_read, count(*) FILTER (year(l_shipdate) = 1998) AS trips_in_year,
       count(DISTINCT CASE WHEN year(l_shipdate) = 1998 THEN cast(l_shipdate AS date) END)
         AS days_in_year
FROM lineitem""",
    # sources
    "log_text_scan": _LOG + r"""
SELECT application_id, count(*) AS num_lines, cast(sum(strlen(value) + 1) AS bigint) AS bytes
FROM parsed GROUP BY application_id""",
    "parquet_multi_scan": r"""
SELECT event_type, count(*) AS num_events
FROM (SELECT event_type FROM events UNION ALL SELECT event_type FROM events)
GROUP BY event_type""",
    "even_ids_doubled": r"""
SELECT o_orderkey * 2 AS doubled FROM orders WHERE o_orderkey % 2 = 0""",
    "sql_view_count": "SELECT count(*) AS total FROM orders",
}
# The same rows, whether they went through files or not.
_EACH_KIND = {
    "resource_request": "resource_requests",
    "container_request": "container_requests",
    "task_event": "task_events",
    "python_times": "python_times",
    "input_split": "input_splits",
    "memory_block": "memory_blocks",
    "memory_capacity": "memory_capacities",
    "broadcast_read": "broadcast_reads",
}
ORACLES |= {
    "message_counts": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, count(*) AS num_messages, count(DISTINCT application_id) AS num_applications"
        f" FROM ({ORACLES[name]}) HAVING count(*) > 0"
        for kind, name in _EACH_KIND.items()
    ),
    "timeline_from_csv": ORACLES["app_timeline"],
    "histogram_from_csv": ORACLES["duration_histogram"],
    "density_from_csv": ORACLES["duration_density"],
    "ordered_parts_from_csv": f"SELECT application_id, app_start, true AS in_order FROM ({ORACLES['app_timeline']})",
}
