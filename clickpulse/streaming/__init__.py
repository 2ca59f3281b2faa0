from clickpulse.streaming.windows import (
    ASCENDING, with_event_time, window_counts_stream, top_n_sink, interval_join_stream,
    url_counts_with_lateness, uv_stream, reconcile_stream, rows_dropped_by_watermark,
    top_n_from_changelog, fired_watermark, pane_counts_stream, pane_window_sink, read_window_counts, bitmap_store_stream, sketch_store_stream)
from clickpulse.streaming.stateful import (
    BlacklistProcessor, LoginBurstProcessor, OrderStateProcessor,
    blacklist_stream, ad_counts_by_province_stream, login_burst_stream, order_states_stream,
    FailSequenceProcessor, OrderPayCepProcessor, fail_sequence_stream, order_pay_cep_stream)
from clickpulse.streaming.panes import fired_counts_stream, sliding_counts_stream
from clickpulse.streaming.ranking import hot_urls_stream, latest_ranking, top_n_stream
from clickpulse.streaming.running import first_seen_stream, read_running, running_sink

__all__ = ["ASCENDING", "with_event_time", "window_counts_stream", "top_n_sink", "interval_join_stream",
           "url_counts_with_lateness", "uv_stream",
           "reconcile_stream", "rows_dropped_by_watermark", "top_n_from_changelog", "fired_watermark",
           "pane_counts_stream", "pane_window_sink", "read_window_counts",
           "BlacklistProcessor", "LoginBurstProcessor", "OrderStateProcessor",
           "blacklist_stream", "ad_counts_by_province_stream", "login_burst_stream", "order_states_stream",
           "FailSequenceProcessor", "OrderPayCepProcessor", "fail_sequence_stream",
           "order_pay_cep_stream",
           "bitmap_store_stream", "sketch_store_stream", "fired_counts_stream", "sliding_counts_stream",
           "hot_urls_stream", "latest_ranking", "top_n_stream",
           "first_seen_stream", "read_running", "running_sink"]
