"""civicflow: city telemetry analytics on Spark (DataFrame / SQL / Structured Streaming).

Modules
  session                 session builder, shared checkpoint root, materialize
  sources.telemetry       the four telemetry streams derived from ``events``
  sources.files           JSON-lines records, CSV lookups
  functions.*             haversine, JSON parse/serialize, event time, alert columns
  operators.*             windows, enrichment, data quality, runs, proximity, incidents
  streaming.io / jobs     stream sources, sinks and jobs; ``stateful`` processors
  plans.*                 the registered queries and their DuckDB oracle
"""

__version__ = "0.1.0"
