"""Log tables derived from the warehouse tables.

The warehouse holds no log files, so the registered queries run on logs rendered
from ``events`` row by row. The renderings are written once, as SQL expressions
both Spark and a plain ANSI engine read the same way; only time formatting
differs, so those are ``{t:name}`` slots filled from the formats below.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# slot -> (Java date pattern, strftime pattern)
TIME_FORMATS = {
    "clf": ("dd/MMM/yyyy:HH:mm:ss '+0000'", "%d/%b/%Y:%H:%M:%S +0000"),
    "day": ("yyyy-MM-dd", "%Y-%m-%d"),
    "clock": ("HH:mm:ss", "%H:%M:%S"),
    "slash": ("yyyy/MM/dd HH:mm:ss", "%Y/%m/%d %H:%M:%S"),
    "httpd": ("EEE MMM dd HH:mm:ss yyyy", "%a %b %d %H:%M:%S %Y"),
    "syslog": ("MMM dd HH:mm:ss", "%b %d %H:%M:%S"),
    "millis": ("yyyy-MM-dd HH:mm:ss.SSS", "%Y-%m-%d %H:%M:%S.%g"),
    "comma": ("yyyy-MM-dd HH:mm:ss,SSS", "%Y-%m-%d %H:%M:%S,%g"),
    "ras": ("yyyy-MM-dd-HH.mm.ss.SSSSSS", "%Y-%m-%d-%H.%M.%S.%f"),
    "compact": ("yyMMdd HHmmss", "%y%m%d %H%M%S"),
    "mon": ("MMM", "%b"),
    "dom": ("dd", "%d"),
    "dotted": ("yyyy.MM.dd", "%Y.%m.%d"),
    "mdy": ("MMddyy", "%m%d%y"),
    "hms": ("HHmmss", "%H%M%S"),
    "second": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    "minute": ("yyyy-MM-dd HH:mm", "%Y-%m-%d %H:%M"),
}

_IP = """(CASE user_id % 4 WHEN 0 THEN '10.0.0.' WHEN 1 THEN '192.168.1.' WHEN 2 THEN '8.8.4.'
 ELSE '45.33.32.' END || CAST(user_id % 250 AS {string}))"""
_AUTH_IP = f"(CASE WHEN event_id % 101 = 0 THEN '198.167.140.21' ELSE {_IP} END)"
_METHOD = """(CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST'
 WHEN event_type = 'error' THEN CASE event_id % 5 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'OPTIONS' WHEN 2 THEN 'trace' ELSE 'POST' END
 ELSE 'GET' END)"""
_PATH = """(CASE event_id % 16 WHEN 0 THEN '/login' WHEN 1 THEN '/app/signin?u=a'
 WHEN 2 THEN '/index.php?id=1 UNION SELECT 1' WHEN 3 THEN '/item?id=1 union all select pw' WHEN 4 THEN '/login/'
 WHEN 5 THEN '/admin' WHEN 6 THEN '/..%2e%2fetc/passwd' WHEN 7 THEN '/search?q=%27%22--' WHEN 8 THEN '/p?x=<script>'
 WHEN 9 THEN '/run?c=;wget' WHEN 10 THEN '/a/../../b.sql' WHEN 11 THEN '/t?k=QUJDREVGR0hJSktMTU5PUFFSU1Q='
 WHEN 12 THEN '/.git/config' ELSE '/page/' || CAST(event_id % 7 AS {string}) END)"""
_STATUS = """(CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN 401 WHEN 1 THEN 403 WHEN 2 THEN 404 ELSE 500 END
 WHEN event_type = 'signup' THEN 302 ELSE 200 END)"""
_BYTES = "CAST(floor(value * 10000) AS bigint)"
_AGENT = """(CASE event_id % 11 WHEN 0 THEN 'sqlmap/1.7' WHEN 1 THEN 'Nikto/2.5' WHEN 2 THEN '' WHEN 3 THEN '-'
 WHEN 4 THEN NULL WHEN 5 THEN 'zaproxy' WHEN 6 THEN 'curl/8.5' ELSE 'Mozilla/5.0' END)"""
_REFERER = """(CASE event_id % 7 WHEN 0 THEN '-' WHEN 1 THEN 'http://evil.tld/x' WHEN 2 THEN 'http://localhost/x'
 WHEN 3 THEN '' ELSE 'https://shop.example/' END)"""
_ID = "CAST(event_id AS {string})"
_LEVEL = "(CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' ELSE 'INFO' END)"
_COMPONENT = "(CASE event_id % 3 WHEN 0 THEN 'sshd' WHEN 1 THEN 'kernel' ELSE 'httpd' END)"
_CONTENT = f"""(CASE event_id % 24
 WHEN 0 THEN 'Failed password for invalid user admin from ' || {_AUTH_IP} || ' port 22 ssh2'
 WHEN 1 THEN 'authentication failure; logname= uid=0 euid=0 tty=NODEVssh ruser= rhost=' || {_AUTH_IP}
 WHEN 2 THEN 'Disconnected from ' || {_AUTH_IP} || ' port 22'
 WHEN 3 THEN 'Connection closed by ' || {_AUTH_IP} || ' port 22'
 WHEN 4 THEN 'Accepted password for ' || (CASE WHEN event_id % 48 = 4 THEN 'guest' ELSE 'admin' END) || ' from ' || {_AUTH_IP}
 WHEN 5 THEN 'cron session opened for user root with error ' || {_ID}
 WHEN 6 THEN 'Connection refused to mysql at ' || {_AUTH_IP}
 WHEN 7 THEN 'Out of memory: Kill process ' || {_ID} || ' (java)'
 WHEN 8 THEN 'kernel panic - not syncing: Fatal exception'
 WHEN 9 THEN 'corrupt data block ' || {_ID} || ' on 10.0.0.1'
 WHEN 10 THEN 'new high-speed USB device number ' || {_ID}
 WHEN 11 THEN 'GET /index.html HTTP 200 ok from ' || {_AUTH_IP}
 WHEN 12 THEN 'Failed password for user root from ' || {_AUTH_IP}
 WHEN 13 THEN 'Invalid user test from ' || {_AUTH_IP}
 WHEN 14 THEN 'GET /../../etc/passwd HTTP/1.1'
 WHEN 15 THEN 'GET /item?id=1 UNION SELECT pw'
 WHEN 16 THEN 'database connection timed out after ' || {_ID} || ' ms'
 WHEN 17 THEN 'php-fpm worker ' || {_ID} || ' exited on SIGSEGV'
 WHEN 18 THEN '"GET /admin HTTP/1.1" 404 512'
 WHEN 19 THEN '"POST /delete_all HTTP/1.1" 500 12'
 WHEN 20 THEN 'mod_jk child workerEnv in error state 6'
 WHEN 21 THEN 'NameNode is in safe mode, heartbeat lost'
 WHEN 22 THEN 'Nikto scan detected from ' || {_AUTH_IP}
 ELSE 'DELETE /config HTTP/1.1' END)"""
_APP_MESSAGE = f"""(CASE WHEN event_id % 10 = 0
 THEN '[HealthCheck] node PASSED CPU: ' || CAST(event_id % 97 AS {{string}}) || '%, Memory: ' || CAST(user_id % 89 AS {{string}}) || '%'
 ELSE CASE event_id % 6
  WHEN 0 THEN 'Failed password for user u' || CAST(user_id AS {{string}}) || ' from ' || {_IP}
  WHEN 1 THEN 'request http://svc/' || CAST(event_id % 7 AS {{string}}) || ' took ' || {_ID} || ' ms'
  WHEN 2 THEN 'Disk usage at ' || CAST(event_id % 100 AS {{string}}) || ' percent on server1'
  WHEN 3 THEN 'timeout: upstream ' || {_IP} || ' returned 503 twice'
  WHEN 4 THEN 'session opened by ' || {_IP} || ' code 404 path /a'
  ELSE 'cache warm for tenant t' || CAST(event_id % 5 AS {{string}}) END END)"""
_RAW = f"""(CASE WHEN event_id % 97 = 0 THEN '~~ no format ' || {_ID} ELSE CASE event_id % 12
 WHEN 0 THEN {_IP} || ' - bob [' || {{t:clf}} || '] "' || upper({_METHOD}) || ' ' || {_PATH} || ' HTTP/1.1" ' || CAST({_STATUS} AS {{string}}) || ' ' || CAST({_BYTES} AS {{string}}) || ' "' || {_REFERER} || '" "' || coalesce({_AGENT}, '-') || '"'
 WHEN 1 THEN {_IP} || ' - - [' || {{t:clf}} || '] "' || upper({_METHOD}) || ' ' || {_PATH} || ' HTTP/1.0" ' || CAST({_STATUS} AS {{string}}) || ' ' || CAST({_BYTES} AS {{string}})
 WHEN 2 THEN {{t:day}} || ' ' || {{t:clock}} || ' ' || {_IP} || ' ' || upper({_METHOD}) || ' /page/' || {_ID} || ' ' || CAST({_STATUS} AS {{string}}) || ' ' || CAST({_BYTES} AS {{string}})
 WHEN 3 THEN {{t:slash}} || ' [error] ' || CAST(user_id AS {{string}}) || '#0: *' || {_ID} || ' open() failed, client: ' || {_IP}
 WHEN 4 THEN {_IP} || ' - - [' || {{t:clf}} || '] "-" ' || CAST({_STATUS} AS {{string}}) || ' 0 "-" "' || coalesce({_AGENT}, '-') || '"'
 WHEN 5 THEN '[' || {{t:httpd}} || '] [' || lower({_LEVEL}) || '] [mod_jk] child init ' || {_ID}
 WHEN 6 THEN {{t:syslog}} || ' combo sshd' || (CASE WHEN user_id % 3 = 0 THEN ': ' ELSE '[' || {_ID} || ']: ' END) || {_CONTENT}
 WHEN 7 THEN {{t:day}} || ' ' || {{t:clock}} || ' ' || {_LEVEL} || ' worker ' || {_ID} || ' done'
 WHEN 8 THEN {{t:millis}} || '  ' || {_LEVEL} || ' ' || {_ID} || ' [main-' || CAST(user_id % 4 AS {{string}}) || '] com.shop.Cart   checkout of ' || {_ID}
 WHEN 9 THEN {{t:ras}} || ' R02-M1-N0 RAS KERNEL ' || {_LEVEL} || ' instruction cache parity error corrected ' || {_ID}
 WHEN 10 THEN {{t:compact}} || ' ' || CAST(user_id AS {{string}}) || ' ' || {_LEVEL} || ' dfs.DataNode$PacketResponder: PacketResponder ' || {_ID} || ' for block terminating'
 ELSE {{t:compact}} || ' ' || {_LEVEL} || ' ntpd node' || CAST(user_id AS {{string}}) || ': synchronized to ' || {_IP} END END)"""

VIEWS: dict[str, dict[str, str]] = {
    "access_log": {
        "line_id": "event_id", "ts": "ts", "timestamp": "{t:second}", "ip": _IP, "method": _METHOD, "path": _PATH,
        "status": _STATUS, "bytes": _BYTES, "user_agent": _AGENT, "referer": _REFERER,
    },
    "auth_log": {
        "line_id": "event_id", "LineId": "event_id", "ts": "ts", "ip": _AUTH_IP, "Component": _COMPONENT,
        "Level": "(CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END)", "Content": _CONTENT,
    },
    "app_log": {
        "line_id": "event_id", "ts": "ts", "timestamp": "{t:comma}", "log_level": _LEVEL, "module": "event_type",
        "message": _APP_MESSAGE,
        "line": "({t:comma} || ' ' || " + _LEVEL + " || ' [' || event_type || '] ' || " + _APP_MESSAGE + ")",
    },
    "raw_lines": {
        "line_id": "event_id",
        "source_file": "(CASE event_id % 12 WHEN 0 THEN 'combined' WHEN 1 THEN 'common' WHEN 2 THEN 'w3c' WHEN 3 THEN 'nginx'"
                       " WHEN 4 THEN 'access' WHEN 5 THEN 'httpd' WHEN 6 THEN 'syslog' WHEN 7 THEN 'simple' WHEN 8 THEN 'java'"
                       " WHEN 9 THEN 'ras' WHEN 10 THEN 'hdfs' ELSE 'tbird' END)",
        "value": _RAW,
    },
    "structured_linux": {
        "line_id": "event_id", "Month": "{t:mon}",
        "Date": "(CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST({t:dom} AS {string}) || '.0' END)",
        "Time": "{t:clock}", "Level": "'combo'", "Component": _COMPONENT, "Content": _CONTENT,
    },
    "structured_bgl": {
        "line_id": "event_id", "Time": "(CASE WHEN event_id % 50 = 0 THEN 'unknown' ELSE {t:ras} END)",
        "Level": "lower(" + _LEVEL + ")", "Component": "'KERNEL'", "Node": "'R02-M1-N0'",
        "Content": "(' ' || " + _CONTENT + ")",
    },
    "structured_thunderbird": {
        "line_id": "event_id", "Month": "{t:mon}", "Day": "{t:dom}", "Time": "{t:clock}",
        "Date": "(CASE WHEN event_id % 3 = 1 THEN '2005' ELSE {t:dotted} END)",
        "Timestamp": "(CASE WHEN event_id % 3 = 0 THEN CAST(1131566461 + event_id AS {string}) ELSE '-' END)",
        "Component": _COMPONENT, "Content": _CONTENT,
    },
    "structured_apache": {
        "line_id": "event_id", "Time": "(CASE WHEN event_id % 50 = 0 THEN 'bad time' ELSE {t:httpd} END)",
        "Level": "(CASE WHEN event_type = 'click' THEN 'notice' ELSE lower(" + _LEVEL + ") END)", "Content": _CONTENT,
    },
    "structured_hdfs": {
        "line_id": "event_id", "Date": "CAST({t:mdy} AS int)", "Time": "CAST({t:hms} AS int)", "Level": _LEVEL,
        "Component": "'dfs.DataNode'", "Content": "(' ' || " + _CONTENT + ")",
    },
    "detections_log": {
        "line_id": "event_id", "timestamp": "{t:second}", "level": _LEVEL, "ip": _AUTH_IP, "message": _CONTENT,
    },
}


def render(expr: str, spark: bool) -> str:
    """Fill the engine-specific slots of one expression."""
    def time_slot(match: re.Match) -> str:
        java, strf = TIME_FORMATS[match.group(1)]
        if spark:
            return "date_format(ts, '{}')".format(java.replace("'", "\\'"))
        return f"strftime(ts, '{strf}')"
    out = re.sub(r"\{t:(\w+)\}", time_slot, expr)
    return out.replace("{string}", "string" if spark else "varchar")


#: Splits from which a table is spread enough.
FEW_PARTITIONS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows of a one-file table over ``FEW_PARTITIONS`` tasks; any table with more partitions is left as it is.

    Regex work on one small file would run in one task. The rule looks at the input's own few partitions, never at the
    cluster: from ``FEW_PARTITIONS`` splits on (about 1 GB) nothing is shuffled.
    """
    return df.repartition(FEW_PARTITIONS, *keys) if df.rdd.getNumPartitions() < FEW_PARTITIONS else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived log tables as a DataFrame; unused columns are pruned down to the scan."""
    events = spread(table(spark, sf_dir, "events"), "event_id")
    return events.select(*[F.expr(render(e, True)).alias(c) for c, e in VIEWS[name].items()])


def view_sql(name: str) -> str:
    """The same table as a SQL subquery for the checking engine."""
    cols = ", ".join(f'{render(e, False)} AS "{c}"' for c, e in VIEWS[name].items())
    return f"(SELECT {cols} FROM events)"


# Reference tables the enrichment joins read; both come from the rows themselves.
def reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ip, abuse_score, ipqs_score: one row per address seen."""
    ip = F.expr(render(_IP, True))
    return (
        table(spark, sf_dir, "events")
        .groupBy(ip.alias("ip"))
        .agg(F.min(F.expr("(user_id * 37) % 101")).cast("int").alias("abuse_score"),
             F.max(F.expr("(user_id * 53) % 131")).cast("int").alias("ipqs_score"))
    )


def reputation_sql() -> str:
    return (
        f"(SELECT {render(_IP, False)} AS ip, CAST(min((user_id * 37) % 101) AS int) AS abuse_score,"
        " CAST(max((user_id * 53) % 131) AS int) AS ipqs_score FROM events GROUP BY 1)"
    )


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """start, end, country, city: one range per /24 seen in the access log."""
    prefix = F.expr(render("(CASE user_id % 4 WHEN 0 THEN 167772160 WHEN 1 THEN 3232235776 WHEN 2 THEN 134743040 ELSE 757145600 END)", True))
    return (
        table(spark, sf_dir, "events").select(prefix.cast("long").alias("start")).distinct()
        .select("start", (F.col("start") + 199).alias("end"),
                F.expr("CASE WHEN start < 200000000 THEN 'US' ELSE 'XX' END").alias("country"),
                F.concat(F.lit("city-"), (F.col("start") % 97).cast("string")).alias("city"))
    )


def geo_ranges_sql() -> str:
    return (
        "(SELECT DISTINCT CAST(CASE user_id % 4 WHEN 0 THEN 167772160 WHEN 1 THEN 3232235776 WHEN 2 THEN 134743040"
        " ELSE 757145600 END AS bigint) AS start FROM events)"
    )
