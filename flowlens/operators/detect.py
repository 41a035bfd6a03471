"""Attack detection over flows, events and logs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowlens import settings
from flowlens.functions.timing import MICROS, moment
from flowlens.functions.values import named
from flowlens.operators.ports import distinct_ports
from flowlens.operators.ranks import DIRECT_ROWS, quantiles
from flowlens.operators.scale import bounded, exact_quantiles, running_total

# Rule names and confidences, in report order.
RULES = {"high_packet_rate": 0.8, "high_byte_rate": 0.75, "syn_flood": 0.85, "port_scan": 0.9}
MODEL_RULE = "ml_detected_attack"
RULE_ORDER = [*RULES, MODEL_RULE]
DETECTION_COLUMNS = ["type", "confidence", "src_ip", "dst_ip", "timestamp", "details"]
# rule_no and flow_key give the order in which detections are reported.
REPORT_ORDER = ["rule_no", "flow_key", "src_ip"]


def flow_thresholds(flows: DataFrame, packet_rate: float = settings.PACKET_RATE_QUANTILE,
                    byte_rate: float = settings.BYTE_RATE_QUANTILE,
                    syn: float = settings.SYN_QUANTILE, **scale) -> dict[str, float | None]:
    """The quantile thresholds of the columns the table has."""
    wanted = {"packet_rate": packet_rate, "byte_rate": byte_rate, "syn_count": syn}
    return exact_quantiles(flows, {c: q for c, q in wanted.items() if c in flows.columns}, **scale)


def _host(flows: DataFrame, name: str) -> Column:
    return named(name) if name in flows.columns else F.lit("unknown")


def _key(flows: DataFrame) -> Column:
    return F.col("flow_key") if "flow_key" in flows.columns else F.lit(None).cast("string")


def _detection(rule: str, src: Column, dst: Column, when: Column, details: Column,
               key: Column, confidence: Column | None = None) -> Column:
    sure = F.lit(RULES[rule]) if confidence is None else confidence
    return F.struct(
        F.lit(rule).alias("type"), sure.alias("confidence"), src.alias("src_ip"),
        dst.alias("dst_ip"), when.alias("timestamp"), details.alias("details"),
        F.lit(RULE_ORDER.index(rule)).alias("rule_no"), key.alias("flow_key"))


def flow_rule_hits(flows: DataFrame, thresholds: dict[str, float | None], as_of=None,
                   syn_floor: int = settings.SYN_FLOOR,
                   rules: Iterable[str] = ("high_packet_rate", "high_byte_rate", "syn_flood"),
                   ) -> DataFrame:
    """The per-flow rules in one pass: a flow yields one row per rule it breaks."""
    src, dst, when, key = _host(flows, "src_ip"), _host(flows, "dst_ip"), moment(as_of), _key(flows)
    tests = {
        "high_packet_rate": ("packet_rate", lambda c, t: c > t, "Packet rate: %.2f", "double"),
        "high_byte_rate": ("byte_rate", lambda c, t: c > t, "Byte rate: %.2f", "double"),
        "syn_flood": ("syn_count", lambda c, t: (c > t) & (c > syn_floor), "SYN count: %d", "bigint"),
    }
    found = []
    for rule in rules:
        column, breaks, text, kind = tests[rule]
        threshold = thresholds.get(column)
        if column not in flows.columns or threshold is None:
            continue
        value = F.nanvl(named(column).cast("double"), F.lit(None).cast("double"))
        details = F.format_string(text, named(column).cast(kind))
        found.append(F.when(breaks(value, F.lit(float(threshold))),
                            _detection(rule, src, dst, when, details, key)))
    if not found:
        nothing = _detection("syn_flood", src, dst, when, F.lit(""), key)
        return flows.where(F.lit(False)).select(F.inline(F.array(nothing)))
    any_hit = found[0].isNotNull()
    for f in found[1:]:
        any_hit = any_hit | f.isNotNull()
    return flows.where(any_hit).select(F.inline(F.array_compact(F.array(*found))))


def port_scans(flows: DataFrame, as_of=None, ports: int = settings.SCAN_PORTS) -> DataFrame:
    """Sources with more than ``ports`` distinct destination ports, one row each.

    Ports are counted from mergeable bitmaps, see ``ports``.
    """
    counted = distinct_ports(flows.where(F.col("src_ip").isNotNull()), ["src_ip"]).where(F.col("ports") > ports)
    return counted.select(F.inline(F.array(_detection(
        "port_scan", F.col("src_ip"), F.lit("multiple"), moment(as_of),
        F.format_string("Unique ports: %d", F.col("ports")), F.lit(None).cast("string")))))


def detect_statistical(flows: DataFrame, as_of=None, thresholds: dict | None = None,
                       syn_floor: int = settings.SYN_FLOOR,
                       ports: int = settings.SCAN_PORTS) -> DataFrame:
    """All rules over a flow table; a rule whose column is missing is left out.

    Pass a written or cached table: thresholds, flow rules and scans each read it.
    """
    limits = flow_thresholds(flows) if thresholds is None else thresholds
    hits = flow_rule_hits(flows, limits, as_of, syn_floor)
    if {"src_ip", "dst_port"} <= set(flows.columns):
        hits = hits.unionByName(port_scans(flows, as_of, ports))
    return hits


def model_hits(scored: DataFrame, as_of=None, normal: str = settings.NORMAL_LABEL,
               threshold: float = settings.CONFIDENCE_THRESHOLD,
               attack_labels: Iterable[str] | None = None) -> DataFrame:
    """Detections from scored rows with ``predicted_label`` and ``confidence``.

    Every label but ``normal`` is an attack; ``attack_labels`` names them instead.
    """
    label = F.col("predicted_label")
    attack = label != normal if attack_labels is None else label.isin(*attack_labels)
    hits = scored.where(attack & (F.col("confidence") > threshold))
    details = F.format_string("ML prediction: attack (confidence: %.2f)", F.col("confidence"))
    return hits.select(F.inline(F.array(_detection(
        MODEL_RULE, _host(scored, "src_ip"), _host(scored, "dst_ip"), moment(as_of), details,
        _key(scored), F.col("confidence")))))


def first_detections(detections: DataFrame, n: int = 5) -> DataFrame:
    return detections.orderBy(*REPORT_ORDER).limit(n)


def fit_baseline(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation per column as a long table."""
    stats = df.agg(*[F.struct(F.lit(c).alias("feature"), F.avg(named(c)).alias("mean"),
                              F.stddev_pop(named(c)).alias("std")).alias(f"s{i}")
                     for i, c in enumerate(columns)])
    return stats.select(F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def detect_outliers(df: DataFrame, baseline: DataFrame, limit: float = settings.Z_LIMIT) -> DataFrame:
    """Rows with a flag, a count and a list of the features further than ``limit`` deviations out.

    The baseline has one row per column of ``df``, so it is read once and put into the plan;
    the check is then one projection without a shuffle.
    """
    found = []
    for feature, mean, std in baseline.select("feature", "mean", "std").collect():
        if feature not in df.columns or mean is None or std is None:
            continue
        value = named(feature).cast("double")
        off = F.abs(value - F.lit(mean))
        score = off / F.lit(std) if std else F.lit(float("inf"))
        found.append(F.when(off > limit * std, F.struct(
            F.lit(feature).alias("feature"), value.alias("value"), F.lit(mean).alias("mean"),
            F.lit(std).alias("std"), score.alias("z_score"))))
    if not found:
        none = F.array().cast("array<struct<feature: string, value: double, mean: double, "
                              "std: double, z_score: double>>")
        return df.select("*", F.lit(False).alias("is_anomaly"), F.lit(0).alias("anomaly_count"),
                         none.alias("anomalies"))
    listed = df.withColumn("anomalies", F.array_compact(F.array(*found)))
    return listed.withColumn("anomaly_count", F.size("anomalies")).withColumn(
        "is_anomaly", F.col("anomaly_count") > 0)


def trailing_counts(events: DataFrame, keys: list[str], time: str = "ts_us",
                    window_us: int = settings.RATE_WINDOW_SECONDS * MICROS,
                    hot_rows: int = 5_000_000) -> DataFrame:
    """Events of the last ``window_us`` microseconds at each instant of a key.

    An event counts from its own instant until just before it is ``window_us`` old. Keys with up
    to ``hot_rows`` events take one window each. Larger ones, at most ``rows / hot_rows`` of them,
    are split over their seconds, see ``_split_counts``; both ways give the same numbers.

    Returns the keys, the time, ``events`` (at that instant) and ``recent``.
    """
    rows = events.where(named(time).isNotNull()).select(*[named(k) for k in keys], named(time))
    sizes = []
    if events.count() > hot_rows:
        sizes = rows.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("_n")).where(
            F.col("_n") > hot_rows).collect()
    if not sizes:
        return _window_counts(rows, keys, time, window_us)
    hot = rows.sparkSession.createDataFrame(
        [tuple(r[:-1]) for r in sizes], rows.select(*[named(k) for k in keys]).schema
    ).withColumnsRenamed({k: f"_h{i}" for i, k in enumerate(keys)})
    same = [named(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)]
    cold_rows = rows.join(F.broadcast(hot), same, "left_anti")
    hot_part = rows.join(F.broadcast(hot), same, "left_semi")
    return _window_counts(cold_rows, keys, time, window_us).unionByName(
        _split_counts(hot_part, keys, time, window_us))


def _steps(rows: DataFrame, keys: list[str], time: str, window_us: int) -> DataFrame:
    """Each event adds one at its time and takes it back when it ages out; the running total of
    these steps is the trailing count. Unlike a sliding frame it costs the same for any window."""
    at = named(time)
    return rows.select(*[named(k) for k in keys], F.inline(F.array(
        F.struct(at.alias(time), F.lit(1).alias("step"), F.lit(1).alias("events")),
        F.struct((at + window_us).alias(time), F.lit(-1).alias("step"), F.lit(0).alias("events")))))


def _window_counts(rows: DataFrame, keys: list[str], time: str, window_us: int) -> DataFrame:
    upto = Window.partitionBy(*[named(k) for k in keys]).orderBy(named(time)).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    counted = _steps(rows, keys, time, window_us).withColumn("recent", F.sum("step").over(upto))
    return counted.where(F.col("events") > 0).groupBy(
        *[named(k) for k in keys], named(time), "recent").agg(F.sum("events").alias("events")).select(
        *[named(k) for k in keys], named(time), "events", "recent")


def _split_counts(rows: DataFrame, keys: list[str], time: str, window_us: int) -> DataFrame:
    """The same for busy keys. Steps are summed per instant before the shuffle and totalled per
    second, so one task sorts at most one second of a key, a million instants."""
    moves = _steps(rows, keys, time, window_us).groupBy(*[named(k) for k in keys], named(time)).agg(
        F.sum("step").alias("step"), F.sum("events").alias("events"))
    seconds = moves.withColumn("_second", F.floor(named(time) / MICROS))
    counted = running_total(seconds, keys, "_second", time, {"recent": "step"})
    return counted.where(F.col("events") > 0).select(
        *[named(k) for k in keys], named(time), "events", "recent")


def rate_limited(events: DataFrame, keys: list[str] | None = None, time: str = "ts_us",
                 threshold: int = settings.RATE_LIMIT,
                 window_us: int = settings.RATE_WINDOW_SECONDS * MICROS,
                 hot_rows: int = 5_000_000) -> DataFrame:
    """Instants at which a key has more than ``threshold`` events in its trailing window."""
    by = keys or ["src_ip", "dst_ip", "dst_port"]
    counted = trailing_counts(events, by, time, window_us, hot_rows)
    return counted.where(F.col("recent") > threshold)


def rule_notices(conn: DataFrame, rules: list[dict]) -> DataFrame:
    """One notice per row and matching rule.

    ``condition`` is a SQL predicate over the columns of ``conn``; a rule without one notes
    nothing. All rules are tested in one pass.
    """
    notes = []
    for no, rule in enumerate(rules):
        if rule.get("condition") is None:
            continue
        condition = F.expr(rule["condition"])
        conn.select(condition.cast("boolean"))  # a bad predicate fails here, by name
        notes.append(F.when(condition, F.struct(
            F.lit(no).alias("rule_no"),
            F.lit(rule.get("description", "Custom rule")).alias("description"),
            F.lit(rule.get("event", "connection_state_remove")).alias("event"),
            F.lit(rule.get("notice_type", "Custom::Attack")).alias("note"),
            F.lit(rule.get("message", "Potential attack detected")).alias("msg"))))
    if not notes:
        return conn.where(F.lit(False)).selectExpr(
            "*", "0 as rule_no", "'' as description", "'' as event", "'' as note", "'' as msg")
    return conn.select("*", F.inline(F.array_compact(F.array(*notes))))


def detect_windows(flows: DataFrame, as_of=None, syn_floor: int = settings.SYN_FLOOR,
                   ports: int = settings.SCAN_PORTS) -> DataFrame:
    """The rules applied to each window of ``window_flows`` on its own.

    Thresholds of all windows are selected together from rank sketches, and ports are counted from bitmaps, so a window with most of
    the flows is no single task. Pass a written or cached table.
    """
    cuts = window_thresholds(flows)
    same = F.col("window_start").eqNullSafe(F.col("_w"))
    rates = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in ("packet_rate", "byte_rate")}
    with_cuts = flows.withColumns(rates).join(bounded(cuts.withColumnRenamed("window_start", "_w")), same)
    src, dst, when, key = _host(flows, "src_ip"), _host(flows, "dst_ip"), moment(as_of), _key(flows)
    tests = [
        ("high_packet_rate", F.col("packet_rate") > F.col("packet_rate_cut"),
         F.format_string("Packet rate: %.2f", F.col("packet_rate"))),
        ("high_byte_rate", F.col("byte_rate") > F.col("byte_rate_cut"),
         F.format_string("Byte rate: %.2f", F.col("byte_rate"))),
        ("syn_flood", (F.col("syn_count") > F.col("syn_count_cut")) & (F.col("syn_count") > syn_floor),
         F.format_string("SYN count: %d", F.col("syn_count"))),
    ]
    hits = with_cuts.select("window_start", F.inline(F.array_compact(F.array(*[
        F.when(test, _detection(rule, src, dst, when, details, key))
        for rule, test, details in tests]))))
    scans = (distinct_ports(flows.where(F.col("src_ip").isNotNull()), ["window_start", "src_ip"]).where(F.col("ports") > ports)
             .select("window_start", F.inline(F.array(_detection(
                 "port_scan", F.col("src_ip"), F.lit("multiple"), when,
                 F.format_string("Unique ports: %d", F.col("ports")), F.lit(None).cast("string"))))))
    return hits.unionByName(scans)


def window_thresholds(flows: DataFrame, rows_per_bucket: int = DIRECT_ROWS) -> DataFrame:
    """Quantile thresholds per window, interpolated between exact ranks.

    Up to ``rows_per_bucket`` flows in all take the built-in ``percentile``; else that is the most rows one task ranks.
    """
    shares = {"packet_rate": settings.PACKET_RATE_QUANTILE, "byte_rate": settings.BYTE_RATE_QUANTILE,
              "syn_count": settings.SYN_QUANTILE}
    if flows.count() <= rows_per_bucket:
        values = [F.nanvl(named(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in shares]
        return flows.select("window_start", *values).groupBy("window_start").agg(*[
            F.percentile(c, F.lit(q)).alias(f"{c}_cut") for c, q in shares.items()])
    long = flows.select("window_start", F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), named(c).cast("double").alias("value")) for c in shares])))
    share = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])[F.col("feature")]
    found = quantiles(long, ["window_start", "feature"], "value", share, rows_per_bucket)
    return found.groupBy("window_start").agg(*[
        F.max(F.when(F.col("feature") == c, F.col("value"))).alias(f"{c}_cut") for c in shares])
