"""Structured Streaming: trades -> watermarked bars -> checkpointed Parquet sinks."""
