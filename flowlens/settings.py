"""Default settings.

Fixed values: every number and word below is part of the expected results and can be
overridden through the argument of the same meaning on the operator that uses it.
"""

# Detection rules.
PACKET_RATE_QUANTILE = 0.95
BYTE_RATE_QUANTILE = 0.95
SYN_QUANTILE = 0.90
SYN_FLOOR = 10
SCAN_PORTS = 50
CONFIDENCE_THRESHOLD = 0.7
Z_LIMIT = 3.0
RATE_WINDOW_SECONDS = 60
RATE_LIMIT = 100

# Block list and history.
BLOCK_SECONDS = 300
HISTORY_KEPT = 1000
HISTORY_SHOWN = 10

# Training.
TEST_SHARE = 0.2
SEED = 42
FOLDS = 5
NEIGHBOURS = 5

# Label vocabulary and its codes.
LABEL_CODES = {"normal": 0, "ddos": 1, "port_scan": 2, "dos": 3, "probe": 4}
NORMAL_LABEL = "normal"

# Columns of a feature export, in order.
EXPORT_COLUMNS = [
    "packet_size", "protocol", "src_port", "dst_port", "flags",
    "flow_duration", "packet_count", "byte_count", "packet_rate", "byte_rate",
]

# Flow columns that are brought to mean 0 and deviation 1.
NORMALISED_COLUMNS = [
    "packet_count", "byte_count", "flow_duration", "packet_rate", "byte_rate",
    "avg_packet_size", "std_packet_size", "min_packet_size", "max_packet_size",
    "src_port", "dst_port", "syn_count", "ack_count", "fin_count", "rst_count",
]

# Identifier columns that are no model input.
IDENTIFIER_COLUMNS = ["id.orig_h", "id.resp_h", "query", "host", "uri", "user_agent"]
UNSCORED_COLUMNS = ["src_ip", "dst_ip", "protocol_type", "flow_key"]

# Log types that are looked for first, in order.
STANDARD_LOGS = [
    "conn", "dns", "http", "ssl", "ssh", "smtp",
    "ftp", "sip", "icmp", "arp", "weird", "notice",
]

# The four columns that identify a connection in every log.
CONNECTION_KEYS = ["id.orig_h", "id.orig_p", "id.resp_h", "id.resp_p"]

# Models, in training order, with their parameters.
MODEL_NAMES = ["random_forest", "svm", "xgboost", "decision_tree", "logistic_regression"]
MODEL_PARAMS = {
    "random_forest": {"trees": 100, "depth": 10, "seed": SEED},
    "svm": {"C": 1.0, "gamma": "scale", "features": 100, "tol": 1e-3, "seed": SEED},
    "xgboost": {"rounds": 100, "depth": 6, "rate": 0.1, "seed": SEED},
    "decision_tree": {"depth": 10, "seed": SEED},
    "logistic_regression": {"max_iter": 1000, "C": 1.0, "tol": 1e-4},
}
