"""Loads every query module."""

from flowlens.plans import (  # noqa: F401
    q_packets, q_detect, q_blocks, q_logs, q_features, q_eval, q_models, q_sources, q_stream, q_runs)
from flowlens.plans.registry import ORACLES, QUERIES  # noqa: F401
