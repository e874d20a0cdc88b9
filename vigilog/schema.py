"""Table schemas and the fixed constants of the detectors."""

from pyspark.sql import types as T

# Detector settings.
ROLLING_WINDOW = 20
Z_THRESHOLD = 2.0
MIN_HISTORY = 5
STD_FLOOR = 1e-6
STATIC_CPU = 80.0
STATIC_MEM = 85.0
CONTAMINATION = 0.05
N_TREES = 100
SEED = 42
SAMPLE_SIZE = 256
INJECTION_RATE = 0.05

# Model input columns, in training order.
FEATURES = [
    "cpu_max_pct",
    "cpu_avg_pct",
    "mem_used_pct",
    "mem_avail_mb",
    "disk_read_mb",
    "disk_write_mb",
    "net_sent_mb",
    "net_recv_mb",
    "top_proc_cpu",
]

ENTRY_FIELDS = [
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("cpu_cores", T.ArrayType(T.DoubleType())),
    T.StructField("cpu_max_pct", T.DoubleType()),
    T.StructField("cpu_avg_pct", T.DoubleType()),
    T.StructField("mem_used_pct", T.DoubleType()),
    T.StructField("mem_avail_mb", T.DoubleType()),
    T.StructField("disk_read_mb", T.DoubleType()),
    T.StructField("disk_write_mb", T.DoubleType()),
    T.StructField("net_sent_mb", T.DoubleType()),
    T.StructField("net_recv_mb", T.DoubleType()),
    T.StructField("top_pid", T.LongType()),
    T.StructField("top_proc_name", T.StringType()),
    T.StructField("top_proc_cpu", T.DoubleType()),
    T.StructField("status", T.StringType()),
    T.StructField("is_anomaly", T.IntegerType()),
    T.StructField("anomaly_type", T.StringType()),
]

ENTRY_COLUMNS = [f.name for f in ENTRY_FIELDS]

# The flat parsed table: entry fields without the nested list, line number last.
TABLE_SCHEMA = T.StructType(
    [f for f in ENTRY_FIELDS if f.name != "cpu_cores"]
    + [T.StructField("line_no", T.LongType())]
)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("line_no", T.LongType()),
        T.StructField("raw_log", T.StringType()),
        T.StructField("sent_at", T.DoubleType()),
        T.StructField("producer", T.LongType()),
        T.StructField("topic", T.StringType()),
    ]
)

ROLLING_REPORT = T.StructType(
    [
        T.StructField("rolling_window", T.IntegerType()),
        T.StructField("z_threshold", T.DoubleType()),
        T.StructField("static_fp", T.LongType()),
        T.StructField("smart_fp", T.LongType()),
        T.StructField("smart_tp", T.LongType()),
        T.StructField("smart_fn", T.LongType()),
        T.StructField("smart_tn", T.LongType()),
        T.StructField("fp_eliminated", T.LongType()),
        T.StructField("static_cpu_thresh", T.DoubleType()),
        T.StructField("static_mem_thresh", T.DoubleType()),
    ]
)

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("total", T.LongType()),
        T.StructField("anomalies", T.LongType()),
        T.StructField("normals", T.LongType()),
        T.StructField("features", T.ArrayType(T.StringType())),
        T.StructField("contamination", T.DoubleType()),
        T.StructField("rolling_baseline", ROLLING_REPORT),
    ]
)

# Quotes inside a quoted field are doubled and a backslash is an ordinary sign.
CSV_DIALECT = {"quote": '"', "escape": '"'}
