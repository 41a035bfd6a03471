"""Queries over the block ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.functions.timing import MICROS, from_micros
from flowlens.operators import blocks
from flowlens.plans.fixtures import table, view
from flowlens.plans.q_detect import statistical
from flowlens.plans.registry import DERIVED, query
from flowlens.session import new_path
from flowlens.sources.ledger import LedgerTable

# A ledger made of the orders: each one an ip and a block time 0 to 699 s after the start.
START_US = 1_704_067_200_000_000
DERIVED["ledger"] = """
select concat('10.', o_orderkey // 62500, '.', o_orderkey // 250 % 250, '.', o_orderkey % 250) as ip,
       1704067200000000 + (o_orderkey * 2 % 700) * 1000000 as block_us,
       case when o_orderstatus = 'F' then 'syn_flood' else 'port_scan' end as reason, 300 as duration
from orders"""
LEDGER_AS_OF = "2024-01-01T00:06:40Z"  # 400 s after the start


def order_ledger(spark, sf):
    rows, no = table(spark, sf, "orders"), F.col("o_orderkey")
    return rows.select(
        F.concat(F.lit("10."), F.floor(no / 62500).cast("string"), F.lit("."), (F.floor(no / 250) % 250).cast("string"),
                 F.lit("."), (no % 250).cast("string")).alias("ip"),
        from_micros(F.lit(START_US) + (F.col("o_orderkey") * 2 % 700) * MICROS).alias("block_time"),
        F.when(F.col("o_orderstatus") == "F", "syn_flood").otherwise("port_scan").alias("reason"),
        F.lit(300).alias("duration"))


def _plain(ledger):
    return ledger.withColumn("block_us", F.unix_micros("block_time")).drop("block_time")


@query("block_new_candidates", """
select src_ip as ip, arg_min(type, (rule_no, coalesce(flow_key, ''))) as reason, 300 as duration from detections
where confidence > 0.7 and src_ip not in (select ip from ledger where 1704067600000000 - block_us <= 300000000)
group by src_ip""")
def block_new_candidates(spark, sf):
    return blocks.new_blocks(statistical(spark, sf), order_ledger(spark, sf), LEDGER_AS_OF).select(
        "ip", "reason", "duration")


@query("block_first_reason", """
select src_ip as ip, arg_min(type, (rule_no, coalesce(flow_key, ''))) as reason from detections
where confidence > 0.7 group by src_ip""")
def block_first_reason(spark, sf):
    return blocks.first_reasons(statistical(spark, sf))


@query("block_upsert", """
with added as (
  select concat('10.0.', n // 256, '.', n % 256) as ip, 1704067600000000 as block_us, 'rate' as reason, 300 as duration
  from (select distinct s_suppkey as n from supplier))
select ip, block_us, reason, duration from added
union all
select ip, block_us, reason, duration from ledger where ip not in (select ip from added)""")
def block_upsert(spark, sf):
    no = F.col("s_suppkey")
    added = table(spark, sf, "supplier").select(
        F.concat(F.lit("10.0."), F.floor(no / 256).cast("string"), F.lit("."),
                 (no % 256).cast("string")).alias("ip"),
        F.lit(LEDGER_AS_OF).cast("timestamp").alias("block_time"),
        F.lit("rate").alias("reason"), F.lit(300).alias("duration")).distinct()
    return _plain(blocks.upsert(order_ledger(spark, sf), added))


@query("ledger_batches", """
with added as (
  select concat('10.0.', n // 256, '.', n % 256) as ip, 1704067600000000 as block_us, 'rate' as reason, 300 as duration
  from (select distinct s_suppkey as n from supplier)),
both_ as (select * from added union all select * from ledger where ip not in (select ip from added))
select ip, block_us, reason, duration from both_
where 1704067600000000 - block_us <= 300000000
  and ip not in (select concat('10.0.', n // 256, '.', n % 256) from (select s_suppkey as n from supplier where s_suppkey % 3 = 0))""")
def ledger_batches(spark, sf):
    """The ledger in batches: blocks, newer blocks, ips that are freed, blocks that are over; compacted in between, one sent again."""
    no = F.col("s_suppkey")
    ip = F.concat(F.lit("10.0."), F.floor(no / 256).cast("string"), F.lit("."), (no % 256).cast("string")).alias("ip")
    suppliers = table(spark, sf, "supplier")
    added = suppliers.select(ip, F.lit(LEDGER_AS_OF).cast("timestamp").alias("block_time"), F.lit("rate").alias("reason"),
                             F.lit(300).alias("duration"))
    held = LedgerTable(spark, new_path(spark, "ledger"), buckets=8)
    held.commit(0, order_ledger(spark, sf))
    held.commit(1, added)
    held.compact()
    held.commit(2, removed=suppliers.where(no % 3 == 0).select(ip))
    held.commit(1, added)
    held.clean(3, LEDGER_AS_OF)
    held.compact()
    held.retire()
    return _plain(held.read())


@query("block_membership", """
select src_ip, count(*) as packets from packets
where src_ip in (select ip from ledger where 1704067600000000 - block_us <= 300000000) group by src_ip""")
def block_membership(spark, sf):
    seen = view(spark, sf, "packets").groupBy(F.col("src_ip").alias("ip")).agg(
        F.count("*").alias("packets"))
    return blocks.blocked_among(seen, order_ledger(spark, sf), LEDGER_AS_OF).withColumnRenamed(
        "ip", "src_ip")


@query("block_expired", """
select ip, block_us, reason, duration from ledger where 1704067600000000 - block_us > 300000000""")
def block_expired(spark, sf):
    return _plain(blocks.expired_blocks(order_ledger(spark, sf), LEDGER_AS_OF))


@query("block_active_list", """
select ip, block_us, reason, duration,
       cast((duration * 1000000 - (1704067600000000 - block_us)) // 1000000 as int) as remaining_seconds
from ledger""")
def block_active_list(spark, sf):
    return _plain(blocks.block_list(order_ledger(spark, sf), LEDGER_AS_OF))


@query("block_cleanup", """
select ip, block_us, reason, duration from ledger
where 1704067600000000 - block_us <= 300000000
  and ip not in (select concat('10.0.', s_suppkey // 256, '.', s_suppkey % 256) from supplier)""")
def block_cleanup(spark, sf):
    no = F.col("s_suppkey")
    freed = table(spark, sf, "supplier").select(
        F.concat(F.lit("10.0."), F.floor(no / 256).cast("string"), F.lit("."),
                 (no % 256).cast("string")).alias("ip"))
    return _plain(blocks.release(blocks.cleanup(order_ledger(spark, sf), LEDGER_AS_OF), freed))


TIMELINE_SQL = """
with recursive hits as ({events}),
chain as (
  select src_ip, min(ts_us) as ts_us from hits group by src_ip
  union all
  select c.src_ip, (select min(h.ts_us) from hits h where h.src_ip = c.src_ip and h.ts_us > c.ts_us + {span})
  from chain c where c.ts_us is not null)
select src_ip as ip, ts_us from chain where ts_us is not null"""


@query("block_timeline", TIMELINE_SQL.format(
    events="select concat('10.2.0.', user_id % 20) as src_ip, epoch_us(ts) as ts_us from events", span=300000000))
def block_timeline(spark, sf):
    events = view(spark, sf, "conn_events")
    return blocks.block_timeline(events).select("ip", "ts_us")


@query("block_timeline_packets", TIMELINE_SQL.format(
    events="select src_ip, ts_us from packets where contains(flags, 'S')", span=1000000))
def block_timeline_packets(spark, sf):
    return blocks.block_timeline(view(spark, sf, "packets").where(F.contains("flags", F.lit("S"))),
                                 duration=1).select("ip", "ts_us")
