"""Streaming: versioned keyed state, sinks, offset ledger, stream jobs."""
