"""These must equal the reference application's for the same
results. Everything else in the package is parameterised."""

# Listing defaults when a field is absent.
UNKNOWN = "Unknown"                     # section, row, seat
DEFAULT_QUANTITY = 1
DELIVERY_DEFAULT = {"seatgeek": "unknown", "mock": "mobile"}
DATE_FALLBACK_DAYS = {"seatgeek": 0, "mock": 30}   # unparseable event date: now + days
UNKNOWN_SOURCE = "unknown"              # history rows without a source

# Detection.
ALERT_TYPE = "price_drop"
CHANGE_TYPES = ("new", "same", "drop", "increase", "invalid", "error")

# Dashboard.
HOURS_CHOICES = (6, 12, 24, 48, 72, 168)
DEFAULT_HOURS = 48                      # also the fixed window of the statistics
HISTORY_LIMIT = 10000
ALERTS_LIMIT = 20
TOP_EVENTS = 5
HISTOGRAM_BINS = 30
CHEAPEST_PER_EVENT = 100                # listings asked of a source per event

# Metrics.
EWMA_ALPHA = 0.1
THROUGHPUT_WINDOW = "5 minutes"

# Retention of the three streams, in days.
RETENTION_DAYS = {"raw_prices": 7, "processed_prices": 30, "price_alerts": 1}

# Notification message.
MSG_TITLE = "🚨 Price Drop Alert!"
MSG_COLOR = 0x00FF00
MSG_FIELD_VENUE = "📍 Venue"
MSG_FIELD_SECTION = "🎫 Section"
MSG_FIELD_PRICE = "💰 Price Change"
MSG_FIELD_DROP = "📉 Drop"
MSG_FIELD_SOURCE = "🔗 Source"
MSG_UNKNOWN_EVENT = "Unknown Event"
MSG_UNKNOWN_VENUE = "Unknown Venue"
MSG_UNKNOWN_SECTION = "Unknown"
MSG_NO_ROW_OR_SEAT = "N/A"
MSG_UNKNOWN_SOURCE = "unknown"
