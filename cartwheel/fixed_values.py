"""Constants that must equal the reference's for identical results.

They are stated once here, in natural order, and imported where used.
"""

import datetime as _dt

# Run parameters (defaults)
LOOKBACK_DAYS = 3
MATCH_WINDOW_MINUTES = 60
WATERMARK_FLOOR = _dt.datetime(1900, 1, 1)

# Raw feed layout
DT_PATTERN = r"dt=([^/]+)"

# Payment-provider event types and statuses
INTENT_TYPE_PREFIX = "payment_intent."
CHARGE_TYPE_PREFIX = "charge."
REFUND_TYPE_PREFIX = "refund."
SUCCEEDED = "succeeded"
REJECTION_REASON = "{id_name} is null"

# Event-key quality tiers: provider id, envelope id, payload hash only
ID_QUALITY = (3, 2, 1)

# Funnel event types
VIEW, CART, PURCHASE = "view", "cart", "purchase"
FUNNEL_EVENT_TYPES = (VIEW, CART, PURCHASE)

# Attribution scores (purchase event, any other event) and match labels
SESSION_MATCH = "user_session"
USER_MATCH = "user_id"
SESSION_MATCH_SCORES = (120, 100)
USER_MATCH_SCORES = (70, 50)

# Metric definitions
ROLLING_WINDOWS = {"wau": 7, "mau": 30}
REPEAT_HORIZONS = (1, 7, 14, 21, 30, 60)
LTV_MAX_AGE = 30
