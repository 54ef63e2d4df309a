"""Structured Streaming: incremental silver loading of landing folders."""
