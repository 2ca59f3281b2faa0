from clickpulse.operators.windows import (
    item_counts, url_counts, channel_behavior_counts, page_views, page_views_salted)
from clickpulse.operators.topn import top_n, hot_items, hot_urls, hot_items_sql, render_topn
from clickpulse.operators.distinct import (
    uv_exact, uv_bitmap, uv_running, uv_hll, bitmap_store, merge_bitmaps, uv_from_bitmaps, sketch_store,
    uv_from_sketches)
from clickpulse.operators.risk import (
    rank_clicks, clicks_passed, blacklist_warnings, ad_counts_by_province, province_counts)
from clickpulse.operators.patterns import (
    consecutive_fails, fails_times_n, order_pay_cep, order_pay_states, login_fail_bursts)
from clickpulse.operators.joins import interval_join, reconcile

__all__ = [
    "item_counts", "url_counts", "channel_behavior_counts", "page_views", "page_views_salted",
    "top_n", "hot_items", "hot_urls", "hot_items_sql", "render_topn",
    "uv_exact", "uv_bitmap", "uv_running", "uv_hll", "bitmap_store", "merge_bitmaps", "uv_from_bitmaps",
    "sketch_store", "uv_from_sketches",
    "rank_clicks", "clicks_passed", "blacklist_warnings", "ad_counts_by_province", "province_counts",
    "consecutive_fails", "fails_times_n", "order_pay_cep", "order_pay_states",
    "login_fail_bursts", "interval_join", "reconcile",
]
