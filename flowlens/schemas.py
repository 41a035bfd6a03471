"""Fixed schemas, as DDL text, of the tables the operators read and write."""

PACKETS = (
    "src_ip string, dst_ip string, protocol int, packet_size int, src_port int, dst_port int, "
    "flags string, protocol_type string, timestamp timestamp, ts_us bigint")

LIVE_FIELDS = (
    "`frame.time` string, `ip.src` string, `ip.dst` string, `ip.proto` int, "
    "`tcp.srcport` int, `tcp.dstport` int, `frame.len` int")

DETECTIONS = (
    "type string, confidence double, src_ip string, dst_ip string, timestamp timestamp, "
    "details string")

BLOCKS = "ip string, block_time timestamp, reason string, duration int"

EVALUATION = (
    "model_name string, accuracy double, precision double, recall double, f1_score double, "
    "roc_auc double, confusion_matrix array<array<bigint>>, "
    "classification_report map<string, struct<precision: double, recall: double, "
    "`f1-score`: double, support: double>>")

BASELINE = "feature string, mean double, std double"
