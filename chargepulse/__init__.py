"""chargepulse: Spark-native top-up, order, payment and browse-log analytics.

Every metric is a DataFrame -> DataFrame function built from Spark SQL
expressions, usable unchanged in batch jobs and inside Structured Streaming
``foreachBatch`` handlers.  Subpackages:

* ``functions`` -- scalar column expressions (IP to number, compact time
  stamps, Java-style tokenising, rates).
* ``sources``   -- readers for dimension text files, topic/file/socket
  streams, JSON files, catalog tables and the named-SQL catalogue.
* ``operators`` -- record parsing, dimension lookups (broadcast with a size
  check, floor/containment range joins) and the indicator aggregates.
* ``streaming`` -- versioned keyed state (replay-safe counters and upserts
  with key-level expiry), sinks, offset ledger and the streaming jobs.
* ``plans``     -- the registered queries over the test tables and their
  DuckDB oracle SQL.
"""

__version__ = "0.1.0"
