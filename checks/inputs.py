"""Log lines and metric records derived from the ``events`` table.

The same SELECT texts serve Spark, one DataFrame after the other, and DuckDB, as
common table expressions; ``{src}`` is the table each of them reads.
"""

from pyspark.sql import DataFrame, SparkSession

READINGS = """
 select event_id, event_id+1 as line_no, ts, event_type, user_id, value as event_value,
  cast(floor(value*2) as bigint)%1000 as v10,
  event_id%20=7 and cast(floor(event_id/20) as bigint)%2=0 as cpu_spike,
  event_id%20=7 and cast(floor(event_id/20) as bigint)%2=1 as mem_spike
 from {src}"""

RECORDS = """
 select *, case when cpu_spike then 950+(event_id*37)%51 else v10 end as c0,
  cast(floor(v10/2) as bigint) as c1, (v10*3+event_id)%400 as c2, (event_id*7)%300 as c3,
  case when mem_spike then 920+(event_id*53)%71 else 300+(v10+event_id*11)%200 end as mem10,
  case when cpu_spike then 'ANOMALY:CPU_SPIKE' when mem_spike then 'ANOMALY:MEM_SPIKE' else 'NORMAL' end as status
 from {src}"""


def _tenths(col: str) -> str:
    return (
        f"cast(cast(floor({col}/10) as bigint) as varchar(20)) || '.' || "
        f"cast({col}%10 as varchar(20))"
    )


TEXTS = f"""
 select line_no, user_id%16 as host_id,
 case when event_id%50=11 then ''
  when event_id%50=13 then '==============='
  else substr(cast(ts as varchar(32)),1,19) || ' | '
  || case when status='NORMAL' then 'INFO    ' else 'WARNING ' end || ' | '
  || 'CPU:[' || {_tenths('c0')} || ',' || {_tenths('c1')} || ',' || {_tenths('c2')} || ','
  || {_tenths('c3')} || '] ' || 'MEM_PCT:' || {_tenths('mem10')}
  || ' MEM_AVAIL:' || cast(16000-mem10*16 as varchar(20)) || '.0MB DISK_R:' || cast(event_id*3 as varchar(20))
  || '.25MB DISK_W:' || cast(event_id*2 as varchar(20)) || '.5MB NET_S:' || cast(event_id as varchar(20))
  || '.75MB NET_R:' || cast(event_id*4 as varchar(20)) || '.0MB TOP_PROC:'
  || case when event_id%50=17 then 'unavailable' when event_id%50=19 then 'pid=9 name=kworker/0:1 cpu=0.0%'
      else 'pid=' || cast(100+user_id as varchar(20)) || ' name=' || event_type || ' cpu='
       || {_tenths('c1')} || '%' end
  || ' STATUS:' || case when event_id%50=23 then 'ANOMALY:UNKNOWN' else status end
 end as value from {{src}}"""

METRICS = f"b as ({READINGS.format(src='{events}')}), m as ({RECORDS.format(src='b')})"
LINES = f"{METRICS}, l as ({TEXTS.format(src='m')})"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def metrics_of(events_df: DataFrame) -> DataFrame:
    spark = events_df.sparkSession
    return spark.sql(RECORDS, src=spark.sql(READINGS, src=events_df))


def lines_of(events_df: DataFrame) -> DataFrame:
    """``line_no, host_id, value``; works on batch and streaming tables."""
    return events_df.sparkSession.sql(TEXTS, src=metrics_of(events_df))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(events(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics_of(events(spark, sf_dir))
