"""Container log lines spelled out from an ``events`` table.

The test tables hold no cluster logs, so this view writes one log line per
event: stamped lines of every known message, and unstamped continuation lines.
Each line is built from its own row by built-in expressions; there is no
shuffle, and the number of lines is the number of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Six clusters, fifteen or more applications, four containers each; container
# 000001 is the application master.
_RUN = """
  concat(1485248649253 + user_id % 6, '_', lpad(cast(user_id AS string), 4, '0'))
"""

_PATH = """
  concat('file:/logs/application_', run, '/container_', run, '_01_',
         lpad(cast(event_id % 4 + 1 AS string), 6, '0'), '.log')
"""

# A cast gives a zone-free time's digits whatever the session zone.
_STAMP = "replace(substring(cast(ts AS string), 3, 17), '-', '/')"

_LINE = f"""
  CASE event_type
    WHEN 'signup' THEN concat('    env CONTINUED ', user_id)
    WHEN 'error' THEN concat(
      {_STAMP}, ' ERROR executor.Executor: Exception in task ', event_id % 7, '.0 in stage ',
      event_id % 5, '.0 (TID ', event_id div 2, ') after INFO')
    WHEN 'click' THEN concat(
      {_STAMP}, ' INFO executor.Executor: ', if(event_id % 2 = 0, 'Running', 'Finished'),
      ' task ', event_id % 7, '.0 in stage ', event_id % 5, '.0 (TID ', user_id div 2, ')',
      if(event_id % 2 = 0, '',
         concat('. ', event_id % 3000, ' bytes result sent to driver')))
    WHEN 'view' THEN CASE
      WHEN event_id % 4 = 0 THEN concat(
        {_STAMP}, ' INFO python.PythonRunner: Times: total = ', event_id % 900 + 100,
        ', boot = ', event_id % 50 - 5, ', init = ', event_id % 30,
        ', finish = ', event_id % 900 + 20)
      WHEN event_id % 4 = 1 THEN concat(
        {_STAMP}, ' INFO rdd.HadoopRDD: Input split: hdfs://10.0.0.1:9000/in/file',
        event_id % 9, '.txt:', event_id * 1000, '+', event_id % 777 + 1)
      WHEN event_id % 20 = 2 THEN concat(
        {_STAMP}, ' INFO storage.MemoryStore: MemoryStore started with capacity ',
        event_id % 12 + 1, '.5 GB')
      WHEN event_id % 4 = 2 THEN concat(
        {_STAMP}, ' INFO storage.MemoryStore: Block rdd_', event_id % 40, '_', event_id % 8,
        ' stored as bytes in memory (estimated size ', event_id % 90 + 1, '.5 ',
        if(event_id % 3 = 0, 'KB', 'MB'), ', free ', event_id % 12 + 1, '.0 GB)')
      ELSE concat(
        {_STAMP}, ' DEBUG broadcast.TorrentBroadcast: Started reading broadcast variable ',
        event_id % 25)
      END
    WHEN 'purchase' THEN CASE
      WHEN event_id % 2 = 0 THEN concat(
        {_STAMP}, ' WARN YarnAllocator: Will request ', event_id % 16 + 1,
        ' executor containers, each with ', event_id % 5 + 1, ' cores and ',
        (event_id % 4 + 1) * 1024, ' MB memory including ',
        (event_id % 4 + 1) * 128, ' MB overhead')
      ELSE concat(
        {_STAMP}, ' INFO YarnAllocator: Container request (host: ',
        if(event_id % 3 = 0, 'Any', concat('mesos-slave-', event_id % 11)),
        ', capability: <memory:', (event_id % 4 + 1) * 1024, ', vCores:',
        event_id % 5 + 1, '>)')
      END
  END
"""


def log_lines_from_events(events: DataFrame) -> DataFrame:
    """``event_id, value, file_path``, one line per event."""
    return events.withColumn("run", F.expr(_RUN)).select(
        "event_id", F.expr(_LINE).alias("value"), F.expr(_PATH).alias("file_path")
    )
