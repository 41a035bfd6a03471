"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowlens.plans.fixtures import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CHECKS: dict[str, str] = {}  # the same texts without the view definitions

# Further views of the check SQL, each built on those before it.
DERIVED = {
    "flow_totals": """
select src_ip, dst_ip, src_port, dst_port, protocol_type,
       count(*) as packet_count, cast(sum(packet_size) as bigint) as byte_count,
       cast(max(ts_us) - min(ts_us) as double) / 1000000 as flow_duration,
       avg(packet_size) as avg_packet_size, stddev_samp(packet_size) as std_packet_size,
       min(packet_size) as min_packet_size, max(packet_size) as max_packet_size,
       count(*) filter (protocol_type = 'tcp' and contains(flags, 'S')) as syn_count,
       count(*) filter (protocol_type = 'tcp' and contains(flags, 'A')) as ack_count,
       count(*) filter (protocol_type = 'tcp' and contains(flags, 'F')) as fin_count,
       count(*) filter (protocol_type = 'tcp' and contains(flags, 'R')) as rst_count
from packets group by all""",
    "flows": """
select concat_ws('_', src_ip, dst_ip, src_port, dst_port, protocol_type) as flow_key, *,
       case when flow_duration > 0 then packet_count / flow_duration
            else cast(packet_count as double) end as packet_rate,
       case when flow_duration > 0 then byte_count / flow_duration
            else cast(byte_count as double) end as byte_rate
from flow_totals""",
    "limits": """
select quantile_cont(packet_rate, 0.95) as p_rate, quantile_cont(byte_rate, 0.95) as b_rate,
       quantile_cont(cast(syn_count as double), 0.90) as syn
from flows""",
    "detections": """
select 'high_packet_rate' as type, 0.8::double as confidence, src_ip, dst_ip, 0 as rule_no, flow_key
from flows, limits where packet_rate > p_rate
union all
select 'high_byte_rate', 0.75::double, src_ip, dst_ip, 1, flow_key from flows, limits where byte_rate > b_rate
union all
select 'syn_flood', 0.85::double, src_ip, dst_ip, 2, flow_key from flows, limits
where syn_count > syn and syn_count > 10
union all
select 'port_scan', 0.9::double, src_ip, 'multiple', 3, null from flows group by src_ip
having count(distinct dst_port) > 50""",
}


def _needs(sql: str, known: dict[str, str]) -> list[str]:
    """The views a text uses, in the order they have to be defined."""
    found: list[str] = []
    for name, body in known.items():
        if f" {name}" in sql.replace("\n", " ").replace(",", " ").replace("(", " "):
            found += [n for n in [*_needs(body, {k: v for k, v in known.items() if k != name}),
                                  name] if n not in found]
    return found


def with_views(sql: str) -> str:
    """Put the definitions of the views a query names in front of it."""
    known = {**VIEWS, **DERIVED}
    parts = [f"{name} as ({known[name]})" for name in _needs(sql, known)]
    if not parts:
        return sql
    head, rest = ("with recursive ", sql.strip()[len("with recursive "):]) if sql.strip().startswith(
        "with recursive ") else ("with ", sql.strip()[5:] if sql.strip().startswith("with ") else None)
    if rest is not None:
        return f"{head}{', '.join(parts)}, {rest}"
    return f"with {', '.join(parts)} {sql}"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its check SQL where SQL can say it."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            CHECKS[name] = oracle
            ORACLES[name] = with_views(oracle)
        return fn
    return add
