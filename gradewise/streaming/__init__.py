"""Structured Streaming: windows by grade, running counter, sinks and query start-up."""
