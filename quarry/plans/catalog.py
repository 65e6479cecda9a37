"""Registry of the user-facing queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.plans import commerce as C
from quarry.plans import files as Fl
from quarry.plans import weblog as L
from quarry.plans import words as Wd

Query = Callable[[SparkSession, str], DataFrame]


def _streaming(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from quarry.streaming import jobs

        return getattr(jobs, name)(spark, sf_dir)

    run.__name__ = name
    return run


QUERIES: dict[str, Query] = {
    # users x transactions
    "product_distinct_locations": C.product_distinct_locations_tables,
    "left_join": C.left_join_tables,
    "left_join_keep": C.left_join_keep_tables,
    "left_join_drop": C.left_join_drop_tables,
    "distinct_pairs": C.distinct_pairs_tables,
    "inner_join": C.inner_join_tables,
    "bucketed_join": C.bucketed_join_tables,
    "bucketed_reports": C.bucketed_reports_tables,
    "spend_by_group": C.spend_by_group_tables,
    "spend_by_location": C.spend_by_location_tables,
    "top_location": C.top_location_tables,
    # words
    "word_count": Wd.word_count_tables,
    "frequent_words": Wd.frequent_words_tables,
    "frequent_words_sketched": Wd.frequent_words_sketched_tables,
    "tokenize": Wd.tokens_per_document,
    "token_positions": Wd.token_positions,
    "hashtags": Wd.hashtags_tables,
    "keyword_track_filter": Wd.keyword_docs_tables,
    # web log
    "parse_access_log": L.logs_tables,
    "rejected_log_lines": L.rejected_tables,
    "log_stats": L.log_stats_tables,
    "sql_log_stats": L.sql_log_stats_tables,
    "response_code_counts": L.response_code_counts_tables,
    "response_code_total": L.response_code_total_tables,
    "sql_response_code_total": L.sql_response_code_total_tables,
    "heavy_hitters": L.heavy_hitters_tables,
    "heavy_hitters_sketched": L.heavy_hitters_sketched_tables,
    "sql_having": L.sql_having_tables,
    "endpoint_counts": L.endpoint_counts_tables,
    "top_endpoints": L.top_endpoints_tables,
    "sql_top_endpoints": L.sql_top_endpoints_tables,
    "log_report": L.log_report_tables,
    "log_report_stats": L.log_report_stats_tables,
    # people / files / sinks
    "range_filter": Fl.range_filter_tables,
    "sql_range_filter": Fl.sql_range_filter_tables,
    "labelled_names": Fl.labelled_tables,
    "csv_typed_people": Fl.csv_typed_people_tables,
    "dynamic_schema_scan": Fl.dynamic_schema_scan_tables,
    "positional_project": Fl.positional_project_tables,
    "tsv_typed_scan": Fl.tsv_typed_scan_tables,
    "stage_snapshots": Fl.stage_snapshots_tables,
    "overwrite_sink": Fl.overwrite_sink_tables,
    "tsv_users_scan": Fl.tsv_users_scan_tables,
    "tsv_distinct_locations": Fl.tsv_distinct_locations_tables,
    "tsv_spend_by_group": Fl.tsv_spend_by_group_tables,
    "tsv_top_location": Fl.tsv_top_location_tables,
    "text_line_scan": Fl.text_line_scan_tables,
    "sql_on_file": Fl.sql_on_file_tables,
    "json_sink_roundtrip": Fl.json_sink_roundtrip_tables,
    "parquet_sink_roundtrip": Fl.parquet_sink_roundtrip_tables,
    "row_text_sink": Fl.row_text_sink_tables,
    "tsv_sink_roundtrip": Fl.tsv_sink_roundtrip_tables,
    # streams
    "stream_word_count": _streaming("stream_word_count"),
    "stream_word_count_batches": _streaming("stream_word_count_batches"),
    "stream_hashtags": _streaming("stream_hashtags"),
    "stream_tracked_hashtags": _streaming("stream_tracked_hashtags"),
    "stream_keyword_track": _streaming("stream_keyword_track"),
    "stream_running_stats": _streaming("stream_running_stats"),
    "stream_log_windows": _streaming("stream_log_windows"),
    "stream_window_heavy_hitters": _streaming("stream_window_heavy_hitters"),
    "stream_window_top_endpoints": _streaming("stream_window_top_endpoints"),
    "stream_closed_top_endpoints": _streaming("stream_closed_top_endpoints"),
    "stream_compacted_windows": _streaming("stream_compacted_windows"),
    "stream_rejected_lines": _streaming("stream_rejected_lines"),
}
