"""Queries over protocol logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.values import named, to_number, trim_names
from flowlens.operators import logs
from flowlens.plans.fixtures import LOG_KEYS, view
from flowlens.plans.registry import DERIVED, query
from flowlens.settings import CONNECTION_KEYS

SHORT = {dotted: plain for plain, dotted in LOG_KEYS.items()}


def _number(column):
    return f"coalesce(try_cast({column} as double), 0)"


def _ratio(a, b):
    return f"case when {b} > 0 then {a} / {b} else 0 end"


DERIVED["conn_numbers"] = "select * replace (" + ", ".join(
    f"{_number(c)} as {c}" for c in ("duration", "orig_bytes", "resp_bytes", "orig_pkts", "resp_pkts")
) + ") from conn_log"
DERIVED["conn_out"] = f"""
select orig_h, orig_p, resp_h, resp_p, proto, duration, orig_bytes, resp_bytes, orig_pkts, resp_pkts,
       orig_bytes + resp_bytes as total_bytes, orig_pkts + resp_pkts as total_pkts,
       {_ratio('orig_bytes', 'orig_pkts')} as avg_orig_pkt_size,
       {_ratio('resp_bytes', 'resp_pkts')} as avg_resp_pkt_size, conn_state,
       {_ratio('orig_bytes', 'duration')} as orig_byte_rate,
       {_ratio('resp_bytes', 'duration')} as resp_byte_rate
from conn_numbers"""
DERIVED["dns_out"] = f"""
select orig_h, orig_p, resp_h, resp_p, query, '' as qclass, qclass_name, '' as qtype, qtype_name,
       rcode, '' as rcode_name, length(query) as query_length, {_number('rtt')} as rtt from dns_log"""
DERIVED["http_numbers"] = "select * replace (" + ", ".join(
    f"{_number(c)} as {c}" for c in ("request_body_len", "response_body_len", "status_code")
) + ") from http_log"
DERIVED["http_out"] = """
select orig_h, orig_p, resp_h, resp_p, method, host, uri, '' as version, '' as user_agent,
       request_body_len, response_body_len, status_code, length(uri) as uri_length,
       request_body_len + response_body_len as total_transfer from http_numbers"""
SAME = " and ".join(f"{{a}}.{k} is not distinct from {{b}}.{k}" for k in LOG_KEYS)
DERIVED["conn_dns"] = f"""
select c.*, d.* exclude (orig_h, orig_p, resp_h, resp_p) from conn_out c
left join dns_out d on {SAME.format(a='c', b='d')}"""
DERIVED["conn_dns_http"] = f"""
select c.*, h.* exclude (orig_h, orig_p, resp_h, resp_p) from conn_dns c
left join http_out h on {SAME.format(a='c', b='h')}"""


def log(spark, sf, kind):
    return view(spark, sf, f"{kind}_log")


def short(df):
    return df.withColumnsRenamed(SHORT)


def weird_log(spark, sf):
    """A generic log: one row per rejected connection, with a column that clashes."""
    conn = log(spark, sf, "conn").where(F.col("conn_state") == "REJ")
    return conn.select(*[named(k) for k in CONNECTION_KEYS], F.lit("rejected").alias("name"), "proto")


@query("log_numeric_coerce", f"select orig_h, orig_p, {_number('duration')} as duration, "
       f"{_number('orig_bytes')} as orig_bytes from conn_log")
def log_numeric_coerce(spark, sf):
    conn = log(spark, sf, "conn")
    return short(conn.select(named("id.orig_h"), named("id.orig_p"),
                             *[to_number(F.col(c)).alias(c) for c in ("duration", "orig_bytes")]))


@query("log_missing_default", """
select orig_h, orig_p, cast('' as varchar) as resp_h, 0 as resp_p, '' as proto, 0::double as total_bytes,
       '' as conn_state from conn_log""")
def log_missing_default(spark, sf):
    bare = log(spark, sf, "conn").select(named("id.orig_h"), named("id.orig_p"))
    return short(logs.conn_features(bare)).select(
        "orig_h", "orig_p", "resp_h", "resp_p", "proto", "total_bytes", "conn_state")


@query("log_trim_names", "select orig_h, orig_p, proto from conn_log")
def log_trim_names(spark, sf):
    padded = short(log(spark, sf, "conn")).select(
        F.col("orig_h").alias(" orig_h"), F.col("orig_p").alias("orig_p  "),
        F.col("proto").alias("\tproto "))
    return trim_names(padded)


@query("conn_features", "select * from conn_out")
def conn_features(spark, sf):
    return short(logs.conn_features(log(spark, sf, "conn")))


@query("dns_features", "select * from dns_out")
def dns_features(spark, sf):
    return short(logs.dns_features(log(spark, sf, "dns")))


@query("http_features", "select * from http_out")
def http_features(spark, sf):
    return short(logs.http_features(log(spark, sf, "http")))


def merged(spark, sf, *kinds):
    found = {k: weird_log(spark, sf) if k == "weird" else log(spark, sf, k) for k in kinds}
    return short(logs.merge_logs(found))


@query("logs_conn_dns", "select * from conn_dns")
def logs_conn_dns(spark, sf):
    return merged(spark, sf, "conn", "dns")


@query("logs_conn_dns_http", "select * from conn_dns_http")
def logs_conn_dns_http(spark, sf):
    return merged(spark, sf, "conn", "dns", "http")


DERIVED["conn_weird"] = f"""
select c.*, w.name, w.proto as proto_weird from conn_out c
left join (select orig_h, orig_p, resp_h, resp_p, 'rejected' as name, proto from conn_log
           where conn_state = 'REJ') w on {SAME.format(a='c', b='w')}"""


@query("logs_generic_join", "select orig_h, orig_p, resp_h, resp_p, conn_state, name from conn_weird")
def logs_generic_join(spark, sf):
    return merged(spark, sf, "conn", "weird").select(*LOG_KEYS, "conn_state", "name")


@query("logs_suffix", "select orig_h, orig_p, resp_p, proto, proto_weird from conn_weird")
def logs_suffix(spark, sf):
    return merged(spark, sf, "conn", "weird").select("orig_h", "orig_p", "resp_p", "proto", "proto_weird")


DERIVED["conn_gaps"] = "select * replace (case when orig_p % 50 = 0 then null else orig_h end as orig_h) from conn_out"
DERIVED["dns_gaps"] = "select * replace (case when orig_p % 50 = 0 then null else orig_h end as orig_h) from dns_out"


@query("logs_null_keys", f"""
select c.orig_h, c.orig_p, c.resp_p, d.query, d.rtt from conn_gaps c
left join dns_gaps d on {SAME.format(a='c', b='d')}""")
def logs_null_keys(spark, sf):
    def gaps(df):
        return df.withColumn("id.orig_h", F.when(named("id.orig_p") % 50 != 0, named("id.orig_h")))
    out = logs.merge_logs({"conn": gaps(log(spark, sf, "conn")), "dns": gaps(log(spark, sf, "dns"))})
    return short(out).select("orig_h", "orig_p", "resp_p", "query", "rtt")


@query("logs_no_conn_base", f"""
select d.orig_h, d.orig_p, d.resp_h, d.resp_p, d.query, d.qclass_name, d.qtype_name, d.rcode, d.rtt,
       h.method, h.host, h.status_code
from dns_log d left join http_out h on {SAME.format(a='d', b='h')}""")
def logs_no_conn_base(spark, sf):
    return merged(spark, sf, "dns", "http").select(
        *LOG_KEYS, "query", "qclass_name", "qtype_name", "rcode", "rtt", "method", "host", "status_code")


@query("logs_skip_unkeyed", "select *, 'stats' as skipped from conn_dns")
def logs_skip_unkeyed(spark, sf):
    skipped: list[str] = []
    unkeyed = log(spark, sf, "http").groupBy("host").agg(F.count("*").alias("n"))
    out = logs.merge_logs({"conn": log(spark, sf, "conn"), "stats": unkeyed,
                           "dns": log(spark, sf, "dns")}, skipped)
    return short(out).withColumn("skipped", F.lit(",".join(skipped)))
