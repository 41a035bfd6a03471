"""Queries that write a view and read it back through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens.operators import evaluate as ev
from flowlens.operators.detect import DETECTION_COLUMNS
from flowlens.operators.features import stratified_split
from flowlens.plans.captures import Captures
from flowlens.plans.fixtures import table, view
from flowlens.plans.q_blocks import order_ledger
from flowlens.plans.q_detect import event_history, flows
from flowlens.plans.q_eval import scored
from flowlens.plans.q_logs import short
from flowlens.plans.registry import query
from flowlens.session import new_path
from flowlens.sources import logs, pcap, tables

PACKET_SQL = """
select src_ip, dst_ip, protocol, packet_size, src_port, dst_port, flags, protocol_type, ts_us from packets"""
CONN_TYPES = {"id.orig_p": "port", "id.resp_p": "port"}


def capture_files(spark, sf, parts=4, **how):
    """The packet view as groups of capture files."""
    return Captures(spark, view(spark, sf, "packets"), parts, **how)


def range_bytes(captures, bytes_per_packet):
    """Bytes of a range, so that the captures of a group are cut into many."""
    return max(4096, captures.packets // captures.groups * bytes_per_packet)


@query("src_pcap_roundtrip", PACKET_SQL)
def src_pcap_roundtrip(spark, sf):
    captures = capture_files(spark, sf)
    return pcap.resolved(pcap.read_groups(spark, captures), captures.names).drop("timestamp")


@query("src_pcap_split", PACKET_SQL)
def src_pcap_split(spark, sf):
    """One capture file read in many ranges, or one such file of each group."""
    captures = capture_files(spark, sf, 1)
    packets = pcap.read_groups(spark, captures, split_bytes=range_bytes(captures, 100))
    return pcap.resolved(packets, captures.names).drop("timestamp")


@query("src_pcap_blocks", PACKET_SQL)
def src_pcap_blocks(spark, sf):
    """Block-structured captures with many sections and two interfaces, each read in many ranges."""
    captures = capture_files(spark, sf, 2, blocks=True)
    packets = pcap.read_groups(spark, captures, split_bytes=range_bytes(captures, 20))
    return pcap.resolved(packets, captures.names).drop("timestamp")


@query("src_pcap_gzip", f"{PACKET_SQL} union all {PACKET_SQL}")
def src_pcap_gzip(spark, sf):
    """Captures of both kinds in gzip; what is inflated is cut into ranges."""
    kinds = [capture_files(spark, sf, 2, blocks=b, zipped=True) for b in (False, True)]
    packets = pcap.read_groups(spark, map(list, zip(*kinds, strict=True)), split_bytes=range_bytes(kinds[0], 20))
    return pcap.resolved(packets, kinds[0].names).drop("timestamp")


@query("src_pcap_corrupt", """
select packet_size < 200 and protocol = 6 as corrupt, count(*) as packets from packets group by all""")
def src_pcap_corrupt(spark, sf):
    """Small TCP packets are cut inside their IP header."""
    rows = view(spark, sf, "packets")
    bad = (F.col("protocol") == 6) & (F.col("packet_size") < 200)
    cut = rows.withColumn("packet_size", F.when(bad, 0).otherwise(F.col("packet_size")))
    counted = pcap.read_groups(spark, Captures(spark, cut, short=True), pcap.corrupt_packets)
    return counted.groupBy("corrupt").agg(F.sum("packets").alias("packets"))


@query("sink_packets_json", PACKET_SQL)
def sink_packets_json(spark, sf):
    path = new_path(spark, "json")
    rows = view(spark, sf, "packets").drop("timestamp")
    tables.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


def conn_log_path(spark, sf):
    path = new_path(spark, "conn")
    logs.write_log(view(spark, sf, "conn_log"), path, "conn", CONN_TYPES)
    return path


@query("src_log_scan", "select * from conn_log")
def src_log_scan(spark, sf):
    return short(logs.read_log(spark, conn_log_path(spark, sf), typed=True))


@query("src_log_hash_in_text", "select orig_h, uri from http_log")
def src_log_hash_in_text(spark, sf):
    path = new_path(spark, "http")
    logs.write_log(view(spark, sf, "http_log"), path, "http", CONN_TYPES)
    return short(logs.read_log(spark, path)).select("orig_h", "uri")


@query("src_log_missing", "select count(*) as conn_rows, 0::bigint as missing_rows from conn_log")
def src_log_missing(spark, sf):
    found = logs.read_log_or_empty(spark, conn_log_path(spark, sf), "uid string")
    absent = logs.read_log_or_empty(spark, new_path(spark, "none"), "uid string")
    return found.select(F.lit("found").alias("k")).unionByName(absent.select(F.lit("absent").alias("k"))).agg(
        F.count_if(F.col("k") == "found").alias("conn_rows"), F.count_if(F.col("k") == "absent").alias("missing_rows"))


@query("src_log_many", """
select 'conn' as kind, 0 as place, count(*) as "rows" from conn_log union all
select 'dns', 1, count(*) from dns_log union all select 'http', 2, count(*) from http_log union all
select 'custom', 3, count(*) from conn_log where conn_state = 'REJ'""")
def src_log_many(spark, sf):
    base = new_path(spark, "logs")
    conn = view(spark, sf, "conn_log")
    made = {"custom": conn.where(F.col("conn_state") == "REJ"), "http": view(spark, sf, "http_log"),
            "ssl": conn.where(F.lit(False)), "dns": view(spark, sf, "dns_log"), "conn": conn}
    for kind, df in made.items():
        logs.write_log(df, f"{base}/{kind}", kind, CONN_TYPES)
    order = ["conn", "dns", "http", "ssl", "custom", "absent"]
    found = logs.read_logs(spark, {k: f"{base}/{k}" for k in order})
    out = None
    for place, (kind, df) in enumerate(found.items()):
        part = df.agg(F.lit(kind).alias("kind"), F.lit(place).alias("place"), F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src_log_discovery", """
select 'conn' as kind, 0 as place, 3 as files, count(*) as "rows" from conn_log union all
select 'dns', 1, 2, count(*) from dns_log union all select 'http', 2, 2, count(*) from http_log union all
select 'custom', 3, 1, count(*) from conn_log where conn_state = 'REJ'""")
def src_log_discovery(spark, sf):
    """Rotated logs in a tree of folders, found by their names: standard types first, then the others."""
    base = new_path(spark, "logs")
    conn = view(spark, sf, "conn_log")
    made = {"custom": (conn.where(F.col("conn_state") == "REJ"), 1, "x/y"), "http": (view(spark, sf, "http_log"), 2, "x"),
            "dns": (view(spark, sf, "dns_log"), 2, "z"), "conn": (conn, 3, "")}
    for kind, (df, parts, folder) in made.items():
        logs.write_log_files(df.repartition(parts), f"{base}/{folder}".rstrip("/"), kind, CONN_TYPES).collect()
    out = None
    for place, (kind, paths) in enumerate(logs.log_files(spark, base).items()):
        part = logs.read_log(spark, paths).agg(
            F.lit(kind).alias("kind"), F.lit(place).alias("place"), F.lit(len(paths)).alias("files"), F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src_log_containers", """
select l_orderkey as uid, l_returnflag = 'A' as local, l_partkey % 3 as parts, case when l_partkey % 3 > 0 then l_suppkey end as first_port,
       case when l_partkey % 3 = 2 then 7::bigint end as last_size from lineitem""")
def src_log_containers(spark, sf):
    """Truth values, sets and vectors, with a separator and words for empty and unset of the log's own."""
    path, n = new_path(spark, "logs"), F.col("l_partkey") % 3
    cells = [F.col("l_orderkey").cast("string"), F.when(F.col("l_returnflag") == "A", "T").otherwise("F"),
             F.when(n == 0, "none").when(n == 1, F.col("l_suppkey").cast("string")).otherwise(F.concat("l_suppkey", F.lit(";0"))),
             F.when(n == 0, "none").when(n == 1, "?").otherwise("5;?;7")]
    lines = table(spark, sf, "lineitem").select(F.concat_ws("|", *cells).alias("value"))
    head = ["#separator \\x7c", "#set_separator|;", "#empty_field|none", "#unset_field|?", "#fields|uid|local|ports|sizes",
            "#types|count|bool|set[port]|vector[count]"]
    spark.createDataFrame([("\n".join(head),)], "value string").coalesce(1).write.text(path)
    lines.write.mode("append").text(path)
    return logs.read_log(spark, path, typed=True).select(
        "uid", "local", F.size("ports").cast("bigint").alias("parts"), F.get("ports", F.lit(0)).cast("bigint").alias("first_port"),
        F.get("sizes", F.lit(2)).alias("last_size"))


@query("src_csv_typed", """
select packet_count, syn_count, byte_rate, conn_state, proto, constant_col, label from training""")
def src_csv_typed(spark, sf):
    path = new_path(spark, "csv")
    tables.write_csv(view(spark, sf, "training"), path)
    return tables.read_csv(spark, path)


@query("sink_csv_roundtrip", """
select flow_key, src_ip, dst_ip, src_port, dst_port, packet_count, byte_count, flow_duration, packet_rate from flows""")
def sink_csv_roundtrip(spark, sf):
    path = new_path(spark, "csv")
    rows = flows(spark, sf).select("flow_key", "src_ip", "dst_ip", "src_port", "dst_port", "packet_count",
                                   "byte_count", "flow_duration", "packet_rate")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


@query("history_roundtrip", """
select event_type as type, 0.8::double as confidence, concat('10.2.0.', user_id % 20) as src_ip,
       '192.168.2.1' as dst_ip, epoch_us(ts) as ts_us, concat('event ', event_id) as details from events""")
def history_roundtrip(spark, sf):
    as_json, as_table = new_path(spark, "history"), new_path(spark, "history")
    tables.save_history(event_history(spark, sf).select(*DETECTION_COLUMNS), as_json)
    tables.append_history(tables.load_history(spark, as_json), as_table)
    out = tables.read_history(spark, as_table)
    return out.withColumn("ts_us", F.unix_micros("timestamp")).drop("timestamp")


@query("blocks_roundtrip", "select ip, block_us, reason, duration from ledger")
def blocks_roundtrip(spark, sf):
    path = new_path(spark, "blocks")
    ledger = order_ledger(spark, sf)
    tables.save_blocks(ledger, path)
    old = ledger.withColumn("reason", F.lit("old"))
    out = tables.load_blocks(spark, path, old)
    return out.withColumn("block_us", F.unix_micros("block_time")).drop("block_time")


@query("evaluation_roundtrip", """
select model_name, round(accuracy, 9) as accuracy, round(f1_score, 9) as f1_score, null::double as roc_auc,
       (select count(*) from scored s where s.model_name = a.model_name and y_true = 1 and y_pred = 0) as missed,
       (select cast(support as double) from classes c where c.model_name = a.model_name and label = 1) as positives
from averages a""")
def evaluation_roundtrip(spark, sf):
    path = new_path(spark, "evaluation")
    tables.save_evaluation(ev.evaluate(scored(spark, sf)), path)
    out = tables.load_evaluation(spark, path)
    return out.select("model_name", F.round("accuracy", 9).alias("accuracy"), F.round("f1_score", 9).alias("f1_score"),
                      "roc_auc", F.get(F.get("confusion_matrix", F.lit(1)), F.lit(0)).alias("missed"),
                      F.col("classification_report")["1"]["support"].alias("positives"))


@query("prepared_roundtrip", """
select o_orderstatus, is_test as held_out, count(*) as "rows", 1 as features from (
  select o_orderstatus, row_number() over (partition by o_orderstatus order by o_orderkey)
         <= floor(count(*) over (partition by o_orderstatus) * 0.2 + 0.5) as is_test from orders) group by all""")
def prepared_roundtrip(spark, sf):
    path = new_path(spark, "prepared")
    train, test = stratified_split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
                                   "o_orderstatus", order="o_orderkey")
    parts = {"X_train": train.select("o_orderkey"), "X_test": test.select("o_orderkey"),
             "y_train": train.select("o_orderstatus"), "y_test": test.select("o_orderstatus")}
    tables.save_prepared(parts, ["o_orderkey"], path)
    back, features = tables.load_prepared(spark, path, list(parts))
    labels = back["y_train"].withColumn("held_out", F.lit(False)).unionByName(
        back["y_test"].withColumn("held_out", F.lit(True)))
    return labels.groupBy("o_orderstatus", "held_out").agg(F.count("*").alias("rows")).withColumn(
        "features", F.lit(len(features)))
