"""Whole runs: captures and logs in, features, detections, blocks and models out.

Every step is a plan; a run writes one table per step and the later steps read the written one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens import settings
from flowlens.functions.timing import iso_text, moment
from flowlens.operators import blocks, detect, evaluate as ev, models as ml
from flowlens.operators.flows import flow_features
from flowlens.operators.logs import merge_logs
from flowlens.session import stage
from flowlens.sources import logs as log_source, tables
from flowlens.sources.pcap import read_groups, read_pcap, resolved

Captured = str | list[str] | Iterable[str | list[str]]


def _kept(df: DataFrame, label: str, path: str | None) -> DataFrame:
    """The table written to ``path``, or staged when no path is given."""
    if path is None:
        return stage(df, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _at(output: str | None, at: dt.datetime | None) -> str | None:
    """The path with the time of the run, if one is given, so that runs do not meet."""
    return output if output is None or at is None else tables.stamped(output, at)


def log_features(spark: SparkSession, files: dict[str, str], output: str | None = None, at: dt.datetime | None = None) -> DataFrame:
    """Log files by type to one merged feature table; ``at`` stamps its path."""
    return _kept(merge_logs(log_source.read_logs(spark, files)), "log-features", _at(output, at))


def capture_flows(spark: SparkSession, path: Captured, output: str | None = None, at: dt.datetime | None = None,
                  names: DataFrame | None = None) -> DataFrame:
    """Capture files, or groups of them that are read one after the other, to the flow table; ``at`` stamps its path, ``names``
    has the names of addresses."""
    packets = read_pcap(spark, path) if isinstance(path, str | list) else read_groups(spark, path)
    return _kept(flow_features(resolved(packets, names)), "flows", _at(output, at))


@dataclass
class Alarm:
    """Detections, the blocks they open and the ledger after them."""
    detections: DataFrame
    opened: DataFrame
    ledger: DataFrame


def detect_and_block(flows: DataFrame, ledger: DataFrame, as_of=None, model: ml.TrainedModel | None = None,
                     auto_block: bool = True, threshold: float = settings.CONFIDENCE_THRESHOLD,
                     duration: int = settings.BLOCK_SECONDS, history: str | None = None) -> Alarm:
    """Rules, and the model if there is one, over a written flow table; then the block ledger."""
    found = detect.detect_statistical(flows, as_of)
    if model is not None:
        found = found.unionByName(detect.model_hits(ml.score(model, flows), as_of, threshold=threshold))
    found = stage(found, "detections")
    if history is not None:
        tables.append_history(found.select(*detect.DETECTION_COLUMNS), history)
    opened = stage(blocks.new_blocks(found, ledger, as_of, auto_block, threshold, duration), "opened")
    return Alarm(found, opened, blocks.cleanup(blocks.upsert(ledger, opened), as_of))


def train(raw: DataFrame, target: str = "label", output: str | None = None,
          params: dict[str, dict] | None = None, at: dt.datetime | None = None,
          ) -> tuple[ml.Prepared, dict[str, ml.TrainedModel], DataFrame]:
    """Preparation, the trained models and the status table; models saved below ``output``, with ``at`` in their names."""
    prepared = ml.prepare(raw, target)
    models, status = ml.train_all(prepared, params=params)
    if output is not None:
        for name, model in models.items():
            ml.save_model(model, _at(f"{output}/{name}", at))
    return prepared, models, status


def evaluate_models(prepared: ml.Prepared, models: dict[str, ml.TrainedModel],
                    output: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Results of all models on the held-out rows, and the best model by F1."""
    scored = stage(ml.score_all(models, prepared.test), "scored")
    results = stage(ev.evaluate(scored, prepared.preparation.labels), "results")
    if output is not None:
        tables.save_evaluation(results, output)
    return results, ev.best_model(results, order=settings.MODEL_NAMES)


def full_run(spark: SparkSession, captures: Captured, logs: dict[str, str], ledger: DataFrame,
             training: DataFrame | None = None, as_of=None, params: dict[str, dict] | None = None,
             models_path: str | None = None, at: dt.datetime | None = None, names: DataFrame | None = None) -> DataFrame:
    """Everything in order, with the training step if there is a table for it; one row that sums the run up.

    Trained models are saved below ``models_path``, stamped with ``at``; ``names`` has the names of captured addresses.
    """
    merged = log_features(spark, logs)
    flows = capture_flows(spark, captures, names=names)
    alarm = detect_and_block(flows, ledger, as_of)
    best = None
    if training is not None:
        prepared, models, status = train(training, params=params, output=models_path, at=at)
        best = evaluate_models(prepared, models)[1].select(F.col("model_name").alias("best_model"))
    sums = [
        merged.agg(F.count("*").alias("log_rows")).withColumn("log_columns", F.lit(len(merged.columns))),
        flows.agg(F.count("*").alias("flows")).withColumn("flow_columns", F.lit(len(flows.columns))),
        alarm.detections.agg(F.count("*").alias("detections")),
        alarm.opened.agg(F.count("*").alias("blocked_ips")),
    ]
    if best is not None:
        sums += [status.agg(F.count_if("trained").alias("trained_models")), best]
    out = sums[0]
    for one in sums[1:]:
        out = out.join(one, F.lit(True))  # one row each
    return out.withColumn("finished", iso_text(moment(as_of)))
