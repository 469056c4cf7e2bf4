"""Structured Streaming: capture of a log into a ledger."""
