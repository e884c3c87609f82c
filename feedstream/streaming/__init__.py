"""Sinks and long-running queries."""
