"""Scans, sinks and shared scratch space."""
