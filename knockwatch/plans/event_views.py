"""Login data read out of the benchmark table ``events``.

Each view exists twice: as Spark SQL and as the same query in plain SQL for the
result check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LOG_YEAR = 2024

# Attempts: five minutes of ``events`` become one second, so that a month fits into
# one morning and the default thresholds fire.
ATTEMPTS_SPARK = """
select event_id, timestamp, ip, status,
  case when event_id % 50 = 0 then ''
       when user_id % 2 = 0 then concat('u', cast(sec div 400 as string))
       else concat('v', cast(event_id % 7 as string)) end as username
from (
  select *, timestamp_ntz'2026-01-12 06:50:00' + make_dt_interval(0, 0, 0, sec) as timestamp,
    concat(case user_id % 4 when 0 then '10.0.' when 1 then '192.168.' when 2 then '203.0.' else '45.32.' end,
           cast(user_id % 3 as string), '.', cast(user_id % 5 as string)) as ip,
    case when event_type in ('error', 'click') then 'failed' else 'success' end as status
  from (select *, (unix_micros(cast(ts as timestamp)) - unix_micros(timestamp'2024-01-01 00:00:00')) div 300000000 as sec
        from {events}))
"""

ATTEMPTS_SQL = """
select event_id, timestamp, ip, status,
  case when event_id % 50 = 0 then ''
       when user_id % 2 = 0 then concat('u', cast(sec // 400 as varchar))
       else concat('v', cast(event_id % 7 as varchar)) end as username
from (
  select *, timestamp '2026-01-12 06:50:00' + to_seconds(sec) as timestamp,
    concat(case user_id % 4 when 0 then '10.0.' when 1 then '192.168.' when 2 then '203.0.' else '45.32.' end,
           cast(user_id % 3 as varchar), '.', cast(user_id % 5 as varchar)) as ip,
    case when event_type in ('error', 'click') then 'failed' else 'success' end as status
  from (select *, (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) // 300000000 as sec from events))
"""

# Log lines: the three messages, a line of another kind, and a line that has the
# words of a message but fails its pattern.
LINES_SPARK = """
select event_id, concat(date_format(ts, 'MMM dd HH:mm:ss'), ' host01 sshd[', cast(event_id as string), ']: ',
  case event_type
    when 'error' then concat('Failed password for ', case when event_id % 2 = 0 then 'invalid user ' else '' end,
      'U', cast(user_id % 7 as string), ' from 10.0.0.', cast(user_id % 5 as string), ' port 22 ssh2')
    when 'click' then concat('Invalid user U', cast(user_id % 7 as string), ' from 10.0.0.', cast(user_id % 5 as string))
    when 'view' then concat('Accepted password for U', cast(user_id % 7 as string), ' from 10.0.0.', cast(user_id % 5 as string), ' port 22 ssh2')
    when 'purchase' then 'Accepted publickey for git from 10.0.0.1 port 22 ssh2'
    else 'Failed password for x from not-an-ip port 22 ssh2' end) as line
from {events}
"""

LINES_SQL = """
select event_id, concat(strftime(ts, '%b %d %H:%M:%S'), ' host01 sshd[', cast(event_id as varchar), ']: ',
  case event_type
    when 'error' then concat('Failed password for ', case when event_id % 2 = 0 then 'invalid user ' else '' end,
      'U', cast(user_id % 7 as varchar), ' from 10.0.0.', cast(user_id % 5 as varchar), ' port 22 ssh2')
    when 'click' then concat('Invalid user U', cast(user_id % 7 as varchar), ' from 10.0.0.', cast(user_id % 5 as varchar))
    when 'view' then concat('Accepted password for U', cast(user_id % 7 as varchar), ' from 10.0.0.', cast(user_id % 5 as varchar), ' port 22 ssh2')
    when 'purchase' then 'Accepted publickey for git from 10.0.0.1 port 22 ssh2'
    else 'Failed password for x from not-an-ip port 22 ssh2' end) as line
from events
"""

# Untidy lines: every few of the lines above are blank, padded, without a real date or time, or cut short.
UNTIDY_LINES_SPARK = f"""
select event_id, case event_id % 13
  when 0 then '' when 1 then ' \t ' when 2 then concat('\t  ', line, ' \t') when 3 then concat('Feb 30', substring(line, 7))
  when 4 then concat('Foo', substring(line, 4)) when 5 then concat(substring(line, 1, 7), '24:00:00', substring(line, 16))
  when 6 then concat(substring(line, 1, 4), '7', substring(line, 7)) when 7 then substring(line, 1, length(line) - 12)
  when 8 then concat(lower(substring(line, 1, 3)), substring(line, 4)) else line end as line
from ({LINES_SPARK})
"""

UNTIDY_LINES_SQL = f"""
select event_id, case event_id % 13
  when 0 then '' when 1 then ' ' || chr(9) || ' ' when 2 then chr(9) || '  ' || line || ' ' || chr(9) when 3 then 'Feb 30' || substring(line, 7)
  when 4 then 'Foo' || substring(line, 4) when 5 then substring(line, 1, 7) || '24:00:00' || substring(line, 16)
  when 6 then substring(line, 1, 4) || '7' || substring(line, 7) when 7 then substring(line, 1, length(line) - 12)
  when 8 then lower(substring(line, 1, 3)) || substring(line, 4) else line end as line
from ({LINES_SQL})
"""

# Untidy attempts: padded and upper-case names, nulls, addresses in and around every private
# range and of other than four parts.
UNTIDY_SPARK = f"""
select event_id, timestamp, status,
  case event_id % 6 when 0 then null when 1 then concat(' ', upper(username), '\t') when 2 then concat(username, ' ') else username end as username,
  case user_id % 11 when 0 then null when 1 then concat('10.1.2.', last) when 2 then concat('172.16.4.', last, ' ')
    when 3 then concat('172.31.4.', last) when 4 then concat('172.32.4.', last) when 5 then concat('192.168.9.', last)
    when 6 then concat('192.169.9.', last) when 7 then concat('fe80::', last) when 8 then concat('1.2.', last)
    when 9 then concat('1.2.3.4.', last) else concat('\t198.51.100.', last) end as ip
from (select a.*, e.user_id, cast(e.event_id % 5 as string) as last
      from ({ATTEMPTS_SPARK}) a join {{events}} e on a.event_id = e.event_id)
"""

UNTIDY_SQL = f"""
select event_id, timestamp, status,
  case event_id % 6 when 0 then null when 1 then ' ' || upper(username) || chr(9) when 2 then username || ' ' else username end as username,
  case user_id % 11 when 0 then null when 1 then '10.1.2.' || last when 2 then '172.16.4.' || last || ' '
    when 3 then '172.31.4.' || last when 4 then '172.32.4.' || last when 5 then '192.168.9.' || last
    when 6 then '192.169.9.' || last when 7 then 'fe80::' || last when 8 then '1.2.' || last
    when 9 then '1.2.3.4.' || last else chr(9) || '198.51.100.' || last end as ip
from (select a.*, e.user_id, cast(e.event_id % 5 as varchar) as last
      from ({ATTEMPTS_SQL}) a join events e on a.event_id = e.event_id)
"""

# Attackers: one that lies in a reported subnet but never appears, and one that is missed.
ATTACKERS = """
select distinct ip from {attempts} where status = 'failed' and (ip like '203.0.%' or ip like '45.32.%')
union select '203.0.1.200' union select '198.51.100.1'
"""

# Attackers for the job over log files: some that fail there, one that is never seen.
JOB_ATTACKERS = "select '10.0.0.' || i as ip from (values (1), (3), (4)) as n(i) union all select '198.51.100.1'"

ATTACKERS_SQL = ATTACKERS.format(attempts="a")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def attempts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ATTEMPTS_SPARK, events=_events(spark, sf_dir))


def lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINES_SPARK, events=_events(spark, sf_dir))


def untidy_lines_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(UNTIDY_LINES_SPARK, events=_events(spark, sf_dir))


def untidy_attempts_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(UNTIDY_SPARK, events=_events(spark, sf_dir))


def attackers_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ATTACKERS, attempts=attempts_view(spark, sf_dir))
