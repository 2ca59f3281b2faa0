from clickpulse.sources.readers import (
    read_user_behavior, read_access_log, read_ad_clicks, read_logins, read_orders,
    read_receipts, market_behavior, malformed_counter,
)

__all__ = ["read_user_behavior", "read_access_log", "read_ad_clicks", "read_logins",
           "read_orders", "read_receipts", "market_behavior", "malformed_counter"]
