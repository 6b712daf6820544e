"""Scans, record intake and sinks."""
