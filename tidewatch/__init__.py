"""tidewatch: sensor-stream cleaning and alerting on Spark.

Every operator is a DataFrame -> DataFrame function with keyword parameters;
see README.md for the operator map and the plans.
"""

from .operators.notify import build_notifications
from .operators.outliers import flag_outliers
from .operators.parse import parse_readings, quarantine
from .operators.project import to_event_alerts, to_sensor_data
from .operators.spikes import flag_spikes
from .operators.stuck import flag_stuck_values
from .operators.thresholds import detect_anomalies, detect_anomalies_incremental
from .operators.timestamps import repair_timestamps
from .plans.pipeline import (clean_and_detect, clean_readings, clean_readings_composed,
                             pipeline_alerts, run_batch, write_batch)
from .plans.skew import HotSet, SkewPlan, find_hot
from .sources.config import read_limits, read_recipients, resolve_limits
from .sources.streams import file_messages, file_readings, kafka_messages
from .sources.tables import readings_from_events
from .streaming.pipeline import start_pipeline

__all__ = [
    "build_notifications", "flag_outliers", "parse_readings", "quarantine", "to_event_alerts",
    "to_sensor_data", "flag_spikes", "flag_stuck_values", "detect_anomalies",
    "detect_anomalies_incremental", "repair_timestamps", "clean_and_detect", "clean_readings",
    "clean_readings_composed", "pipeline_alerts", "run_batch", "write_batch", "HotSet",
    "SkewPlan", "find_hot", "read_limits", "read_recipients", "resolve_limits",
    "file_messages", "file_readings", "kafka_messages", "readings_from_events",
    "start_pipeline",
]
