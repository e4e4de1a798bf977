"""Incremental ingestion whose results agree with the batch operators."""
