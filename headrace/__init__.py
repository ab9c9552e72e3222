"""Headrace: keep one serving table current from batch files and live streams.

Everything is a Spark DataFrame, Spark SQL or Structured Streaming job:

* ``sources``    where rows come from and go to: Parquet files, committed tables, JDBC, named views
* ``functions``  column-level rules: names and types, the message envelope, synthetic trips
* ``operators``  table-level work: change feed, counts, key sets, mirror, serving merge, changelog
* ``streaming``  topics, pass-through, stream-to-table with auto-sync
* ``plans``      the composed runs: ingest, export, reload, the daily chain, the lambda view
"""

__version__ = "0.1.0"
