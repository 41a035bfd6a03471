"""Views over the driver tables in the shapes the operators read.

Each block runs unchanged in Spark SQL and in DuckDB, so the same text serves the plan and
its check.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.functions.timing import from_micros, local_micros

VIEWS = {
    "packets": """
select concat('10.0.', cast(cast(floor(l_suppkey / 256) as int) as string), '.', cast(l_suppkey % 256 as string)) as src_ip,
       concat('192.168.0.', cast(l_partkey % 16 as string)) as dst_ip,
       case when l_partkey % 10 = 0 then 1 when l_partkey % 10 = 1 then 47
            when l_partkey % 10 <= 4 then 17 else 6 end as protocol,
       case when l_partkey % 10 = 0 then 'icmp' when l_partkey % 10 = 1 then 'other'
            when l_partkey % 10 <= 4 then 'udp' else 'tcp' end as protocol_type,
       case when l_partkey % 10 <= 1 then 0 else 1024 + cast(l_partkey % 4 as int) end as src_port,
       case when l_partkey % 10 <= 1 then 0
            when l_suppkey % 10 = 0 then 1 + cast(l_partkey % 1000 as int)
            when l_partkey % 10 <= 4 then 53
            when l_partkey % 3 = 0 then 443 else 80 end as dst_port,
       case when l_partkey % 10 < 5 then '' when l_returnflag = 'A' then 'S'
            when l_returnflag = 'N' then 'SA' when l_linestatus = 'F' then 'FA'
            when l_linenumber = 7 then 'R' else 'PA' end as flags,
       40 + 28 * cast(l_quantity as int) as packet_size,
       1704067200000000 + (l_suppkey * 31 % 3600) * 1000000
         + (l_orderkey * 7919 + l_linenumber * 104729) % 4000000 as ts_us
from lineitem""",
    "conn_log": """
select concat('10.1.', cast(o_orderkey % 200 as string), '.1') as orig_h,
       1024 + cast(o_orderkey % 50000 as int) as orig_p,
       '192.168.1.1' as resp_h,
       case when o_orderkey % 3 = 0 then 53 when o_orderkey % 3 = 1 then 80 else 443 end as resp_p,
       case when o_orderkey % 3 = 0 then 'udp' else 'tcp' end as proto,
       case when o_orderkey % 7 = 0 then '-' else cast(o_custkey % 90 as string) end as duration,
       case when o_orderkey % 11 = 0 then '-' else cast(o_orderkey % 5000 as string) end as orig_bytes,
       cast(o_custkey % 9000 as string) as resp_bytes,
       cast(o_orderkey % 13 as string) as orig_pkts,
       cast(o_custkey % 17 as string) as resp_pkts,
       case when o_orderstatus = 'O' then 'S0' when o_orderstatus = 'F' then 'SF' else 'REJ' end as conn_state
from orders""",
    "dns_log": """
select concat('10.1.', cast(l_orderkey % 200 as string), '.1') as orig_h,
       1024 + cast(l_orderkey % 50000 as int) as orig_p,
       '192.168.1.1' as resp_h, 53 as resp_p,
       concat('h', cast(l_partkey % 50 as string), '.example') as query,
       'C_INTERNET' as qclass_name,
       case when l_partkey % 2 = 0 then 'A' else 'AAAA' end as qtype_name,
       cast(l_partkey % 4 as int) as rcode,
       case when l_linenumber = 1 then '-' else cast(l_linenumber as string) end as rtt
from lineitem where l_orderkey % 3 = 0""",
    "http_log": """
select concat('10.1.', cast(l_orderkey % 200 as string), '.1') as orig_h,
       1024 + cast(l_orderkey % 50000 as int) as orig_p,
       '192.168.1.1' as resp_h, 80 as resp_p,
       case when l_partkey % 5 = 0 then 'POST' else 'GET' end as method,
       concat('site', cast(l_suppkey % 20 as string), '.example') as host,
       concat('/p/', cast(l_partkey as string), '#top') as uri,
       case when l_linenumber = 3 then '-' else cast(l_partkey % 700 as string) end as request_body_len,
       cast(l_partkey % 9000 as string) as response_body_len,
       case when l_partkey % 9 = 0 then '404' else '200' end as status_code
from lineitem where l_orderkey % 3 = 1""",
    "conn_events": """
select event_id,
       concat('10.2.0.', cast(user_id % 20 as string)) as src_ip,
       concat('192.168.2.', cast(length(event_type) as string)) as dst_ip,
       case when event_type = 'error' then 22 else 443 end as dst_port,
       ts
from events""",
    "training": """
select cast(l_quantity as int) as packet_count,
       l_linenumber as syn_count,
       case when l_linenumber = 7 then cast(null as double) else l_tax end as byte_rate,
       case when l_linenumber = 6 then cast(null as string) else l_returnflag end as conn_state,
       l_linestatus as proto,
       1 as constant_col,
       case when l_quantity > 46 and l_linenumber > 3 then 'ddos'
            when l_quantity < 4 then 'port_scan' else 'normal' end as label
from lineitem""",
    "predictions": """
select doc_id, toxic as y_true,
       case when doc_id % 7 = 0 then 1 - toxic else toxic end as y_pred,
       cast((doc_id * 37) % 101 as double) / 100 as score
from labels""",
}

LOG_KEYS = {"orig_h": "id.orig_h", "orig_p": "id.orig_p", "resp_h": "id.resp_h",
            "resp_p": "id.resp_p"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views, with times as TIMESTAMP and log keys under their dotted names."""
    text = VIEWS[name]
    source = re.search(r"from (\w+)", text).group(1)
    body = text.replace(f"from {source}", "from {source}")
    df = spark.sql(body, source=table(spark, sf_dir, source))
    if name == "packets":
        return df.withColumn("timestamp", from_micros(F.col("ts_us")))
    if name == "conn_events":
        at = local_micros(F.col("ts"))
        return df.withColumn("ts_us", at).withColumn("ts", from_micros(at))
    if name.endswith("_log"):
        return df.withColumnsRenamed(LOG_KEYS)
    return df
