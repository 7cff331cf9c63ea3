"""Structured Streaming pipelines (SRC-19/20, STM-1..8)."""

from tessera.streaming.streams import (
    file_stream, parse_numbers, per_batch_value_counts, flight_etl, write_etl_batch, score_posts,
    filter_posts, run_available, run_for, TerminationWatcher, create_etl_table, run_batches, write_batch,
    value_counts_writer, nb_scores_writer, etl_writer,
)

__all__ = ["file_stream", "parse_numbers", "per_batch_value_counts", "flight_etl", "write_etl_batch",
           "score_posts", "filter_posts", "run_available", "run_for", "TerminationWatcher",
           "create_etl_table", "run_batches", "write_batch", "value_counts_writer", "nb_scores_writer", "etl_writer"]
