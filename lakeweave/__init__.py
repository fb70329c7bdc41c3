"""lakeweave: medallion (bronze / silver / gold) event analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from
built-in Spark expressions, usable on static and streaming input alike
unless its docstring says otherwise.  Operator IDs (S1, P2, F6, A1, ...)
"""

from .functions.messages import decode_envelope, encode_messages, parse_json
from .functions.rules import Rule, rules_for
from .functions.timefmt import event_time, flatten_window, timestamps_as_text
from .operators.bronze import corrupt_split, to_bronze
from .operators.current import current_state
from .operators.dedup import dedup_first, dedup_latest, dedup_stream
from .operators.derive import (classify_customers, order_total_check, payable_orders,
                               running_stock, stock_movements)
from .operators.gold import customer_activity, product_units, revenue
from .operators.prefix import clamped_running_sum, running_sum
from .operators.quality import layer_counts
from .operators.silver import observe_rejects, reject_counts, silver_entity, to_silver
from .sinks.files import compact_layer, create_database, load_table, publish, write_layer
from .sources.layers import read_envelope_stream, read_layer, read_layer_stream, read_topic
from .streaming.runner import run_append, run_update

__version__ = "0.1.0"

__all__ = [
    "Rule", "rules_for", "encode_messages", "decode_envelope", "parse_json",
    "event_time", "flatten_window", "timestamps_as_text",
    "to_bronze", "corrupt_split", "to_silver", "silver_entity", "reject_counts", "observe_rejects",
    "dedup_stream", "dedup_first", "dedup_latest", "current_state",
    "revenue", "product_units", "customer_activity", "layer_counts",
    "order_total_check", "stock_movements", "running_stock", "classify_customers", "payable_orders",
    "running_sum", "clamped_running_sum",
    "read_topic", "read_envelope_stream", "read_layer", "read_layer_stream",
    "run_append", "run_update", "write_layer", "load_table", "compact_layer", "create_database", "publish",
]
