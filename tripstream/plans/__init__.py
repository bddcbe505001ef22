"""Shared plan shapes and the query registry."""

from .prefix import keyed_scan, time_bucket

__all__ = ["keyed_scan", "time_bucket"]
