"""tripstream: event and batch analytics on Spark DataFrames, SQL and Structured Streaming.

Subpackages:
  functions  – Column-expression scalar functions (geo grid, time, text) and SQL registration
  sources    – readers/writers for rides, fares, car events, mails, edges, catalog, fixtures
  operators  – batch operators (DataFrame in, DataFrame out)
  plans      – shared plan shapes (bucketed prefix scans) and the query registry
  streaming  – Structured Streaming forms, stateful processors
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
