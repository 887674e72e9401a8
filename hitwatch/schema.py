"""Record types and thresholds."""

from __future__ import annotations

from dataclasses import dataclass

# Topics, schemas and thresholds of the monitored deployment.
LOG_TOPIC = "http-logs"
MONITORING_TOPIC = "http-logs-monitoring"
ALERT_TOPIC = "alerts"

ALERT_SCHEMA = (
    "timestamp string, type string, message string, batch_id long, url string, ip string, "
    "total_requests long, error_requests long, value double, thresholds double"
)
MONITORING_SCHEMA = (
    "ip string, timestamp string, method string, url string, status int, size int"
)
MESSAGE_SCHEMA = "topic string, partition int, offset long, timestamp timestamp, value string"
STEP_SCHEMA = "topic string, partition int, tick long, offset_after long, opened long"

ERROR_STATUS_FROM = 400
WINDOW_SIZE = "30 seconds"
WINDOW_SLIDE = "10 seconds"
WATERMARK = "30 seconds"
REPORT_EVERY = "10 seconds"
CLIENT_RSD = 0.05  # relative deviation the approximate distinct client count may have
CLIENT_SKETCH = 12  # logarithm of its registers: 1.6 %, and next to none up to 500 clients
TOP_URLS = 3
TRACKED_URLS = 96  # URLs a sketch keeps counts of, in a table of 128 places
ALERT_SPAN = "10 seconds"  # of event time that alerts without micro-batches are counted by
ALERT_REPEATS_WITHIN = "2 hours"  # in which a batch may be delivered again
WINDOW_ALERT_ABOVE = 10
WINDOW_ALERT_TEXT = "Alerte: trop d'erreurs"


@dataclass(frozen=True)
class Thresholds:
    """Error rates above these raise alerts; small groups are left alone."""

    everything: float = 0.025
    url: float = 0.3
    ip: float = 0.4
    min_url_requests: int = 5
    min_ip_requests: int = 3
