"""Queries over training tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowlens import settings
from flowlens.functions.values import named
from flowlens.operators import features as ft
from flowlens.operators.flows import flow_features
from flowlens.operators.models import prepare
from flowlens.operators.smote import oversample
from flowlens.plans.fixtures import table, view
from flowlens.plans.registry import DERIVED, query
from flowlens.session import stage

DERIVED["rows_once"] = "select distinct * from training"
DERIVED["cleaned"] = """
select packet_count, syn_count,
       coalesce(byte_rate, (select median(byte_rate) from rows_once)) as byte_rate,
       coalesce(conn_state, (select conn_state from rows_once where conn_state is not null
                             group by conn_state order by count(*) desc, conn_state limit 1)) as conn_state,
       proto, constant_col, label from rows_once"""
DERIVED["label_sizes"] = "select label, count(*) as n from rows_once group by label"


def training(spark, sf):
    return view(spark, sf, "training")


@query("columns_by_type", """
select * from (values ('packet_count', 'numeric'), ('syn_count', 'numeric'), ('byte_rate', 'numeric'),
  ('constant_col', 'numeric'), ('conn_state', 'text'), ('proto', 'text'), ('label', 'text')) t("column", kind)
join (unpivot (select count(packet_count) as packet_count, count(syn_count) as syn_count,
  count(byte_rate) as byte_rate, count(constant_col) as constant_col, count(conn_state) as conn_state,
  count(proto) as proto, count(label) as label from training) on columns(*) into name "column" value cells)
using ("column")""")
def columns_by_type(spark, sf):
    rows = training(spark, sf)
    cells = rows.agg(*[F.struct(F.lit(c).alias("column"), F.lit(kind).alias("kind"),
                                F.count(c).alias("cells")).alias(c)
                       for kind, names in ft.column_kinds(rows).items() for c in names])
    return cells.select(F.inline(F.array(*cells.columns)))


@query("dedup_rows", "select * from rows_once")
def dedup_rows(spark, sf):
    return training(spark, sf).dropDuplicates()


@query("data_quality_counts", """
select count(*) as "rows", cast(sum((byte_rate is null)::int + (conn_state is null)::int) as bigint) as missing_cells,
       count(*) - (select count(*) from rows_once) as duplicate_rows from training""")
def data_quality_counts(spark, sf):
    return ft.quality_counts(training(spark, sf))


@query("impute_median", """
select median(packet_count) as packet_count, median(syn_count) as syn_count, median(byte_rate) as byte_rate
from training""")
def impute_median(spark, sf):
    rows = training(spark, sf)
    found = ft.medians(rows, ["packet_count", "syn_count", "byte_rate"])
    return rows.limit(1).select(*[F.lit(v).alias(c) for c, v in found.items()])


@query("impute_mode", """
select (select conn_state from training where conn_state is not null group by 1 order by count(*) desc, 1 limit 1)
         as conn_state,
       (select proto from training group by 1 order by count(*) desc, 1 limit 1) as proto,
       (select label from training group by 1 order by count(*) desc, 1 limit 1) as label""")
def impute_mode(spark, sf):
    rows = training(spark, sf)
    found = ft.modes(rows, ["conn_state", "proto", "label"])
    return rows.limit(1).select(*[F.lit(v).alias(c) for c, v in found.items()])


@query("clean_table", "select * from cleaned")
def clean_table(spark, sf):
    return ft.clean(training(spark, sf))


@query("label_encode", """
select packet_count, syn_count, byte_rate, dense_rank() over (order by conn_state) - 1 as conn_state,
       dense_rank() over (order by proto) - 1 as proto, dense_rank() over (order by label) - 1 as label
from cleaned""")
def label_encode(spark, sf):
    rows = ft.clean(training(spark, sf)).drop("constant_col")
    names = ["conn_state", "proto", "label"]
    return ft.encode(rows, ft.fit_codes(rows, names), names)


@query("label_codes_text", """
select o_orderkey, dense_rank() over (order by cast(o_custkey as varchar)) - 1 as o_custkey from orders""")
def label_codes_text(spark, sf):
    """A numeric target is coded by its text too."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return ft.encode(rows, ft.fit_codes(rows, ["o_custkey"]), ["o_custkey"])


@query("label_vocabulary", """
select label, case label when 'normal' then 0 when 'ddos' then 1 when 'port_scan' then 2 when 'dos' then 3
       when 'probe' then 4 end as code, count(*) as "rows" from training group by label""")
def label_vocabulary(spark, sf):
    codes = F.create_map(*[F.lit(x) for pair in settings.LABEL_CODES.items() for x in pair])
    return ft.class_counts(training(spark, sf), "label").select(
        "label", codes[F.col("label")].alias("code"), "rows")


@query("constant_columns", """
select unnest(['packet_count', 'syn_count', 'byte_rate', 'conn_state', 'proto', 'constant_col', 'label']) as "column",
       unnest([count(distinct packet_count) <= 1, count(distinct syn_count) <= 1, count(distinct byte_rate) <= 1,
               count(distinct conn_state) <= 1, count(distinct proto) <= 1, count(distinct constant_col) <= 1,
               count(distinct label) <= 1]) as is_constant from training""")
def constant_columns(spark, sf):
    return ft.constant_flags(training(spark, sf))


@query("feature_select", "select packet_count, syn_count, byte_rate, conn_state, proto, label from rows_once")
def feature_select(spark, sf):
    rows = training(spark, sf).dropDuplicates().withColumn("uri", F.concat(F.lit("/"), "proto")).withColumn(
        "id.orig_h", F.col("conn_state"))
    return ft.select_features(rows, "label")[0]


@query("class_counts", 'select label, count(*) as "rows" from training group by label')
def class_counts(spark, sf):
    return ft.class_counts(training(spark, sf), "label")


@query("standard_scale", """
select flow_key, round((packet_count - avg(packet_count) over ()) / stddev_pop(packet_count) over (), 6) + 0::double as packet_count,
       round((byte_count - avg(byte_count) over ()) / stddev_pop(byte_count) over (), 6) + 0::double as byte_count from flows""")
def standard_scale(spark, sf):
    rows = stage(flow_features(view(spark, sf, "packets")).select("flow_key", "packet_count", "byte_count"), "flows")
    out = ft.scale(rows, ft.fit_scaler(rows, ["packet_count", "byte_count"]))
    return out.select("flow_key", *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in ("packet_count", "byte_count")])


SCALED = settings.NORMALISED_COLUMNS


@query("normalize_flows", "select flow_key, dense_rank() over (order by protocol_type) - 1 as protocol_type_encoded, "
       + ", ".join(f"round(({c} - avg({c}) over ()) / stddev_pop({c}) over (), 5) + 0::double as {c}" for c in SCALED)
       + " from flows")
def normalize_flows(spark, sf):
    rows = stage(flow_features(view(spark, sf, "packets")), "flows")
    out = ft.normalise_flows(rows)
    return out.select("flow_key", "protocol_type_encoded", *[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in SCALED])


@query("score_fillna", """
select packet_count, syn_count, coalesce(byte_rate, 0) as byte_rate, conn_state from rows_once""")
def score_fillna(spark, sf):
    rows = training(spark, sf).dropDuplicates()
    return ft.fill_for_scoring(rows).select("packet_count", "syn_count", "byte_rate", "conn_state")


@query("stratified_split", """
select o_orderkey, o_orderstatus,
       row_number() over (partition by o_orderstatus order by o_orderkey)
         <= floor(count(*) over (partition by o_orderstatus) * 0.2 + 0.5) as is_test from orders""")
def stratified_split(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return ft.mark_test_rows(rows, "o_orderstatus", order="o_orderkey")


@query("cv_fold_sizes", """
select o_orderstatus, cast(fold - 1 as int) as fold, count(*) as "rows", min(o_orderkey) as first_key, max(o_orderkey) as last_key
from (select *, ntile(5) over (partition by o_orderstatus order by o_orderkey) as fold from orders) group by all""")
def cv_fold_sizes(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return ft.mark_folds(rows, "o_orderstatus", order="o_orderkey").groupBy("o_orderstatus", "fold").agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("smote_class_counts", 'select label, (select max(n) from label_sizes) as "rows" from label_sizes')
def smote_class_counts(spark, sf):
    rows = stage(ft.clean(training(spark, sf)).drop("constant_col"), "clean")
    names = ["conn_state", "proto"]
    coded = ft.encode(rows, ft.fit_codes(rows, names), names)
    out = oversample(coded, "label", [c for c in coded.columns if c != "label"])
    return ft.class_counts(out, "label")


@query("prepare_training", """
select 'test' as part, label, cast(floor(n * 0.2 + 0.5) as bigint) as "rows" from label_sizes union all
select 'train', label, cast((select max(n - floor(n * 0.2 + 0.5)) from label_sizes) as bigint) from label_sizes""")
def prepare_training(spark, sf):
    done = prepare(training(spark, sf))
    names = F.array(*[F.lit(v) for v in done.preparation.labels])
    train = done.train.select(F.lit("train").alias("part"), F.get(names, F.col("label_index").cast("int")).alias("label"))
    return train.unionByName(done.test.select(F.lit("test").alias("part"), "label")).groupBy("part", "label").agg(
        F.count("*").alias("rows"))


@query("score_columns", """
select src_port, dst_port, packet_count, byte_count, flow_duration, packet_rate, byte_rate, avg_packet_size,
       min_packet_size, max_packet_size, syn_count, ack_count, fin_count, rst_count from flows""")
def score_columns(spark, sf):
    rows = flow_features(view(spark, sf, "packets")).drop("std_packet_size")
    return rows.select(*[named(c) for c in ft.scoring_columns(rows)])
