"""runway: delay-prediction features and route analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   - table scans, stand-in views over the test tables, sinks.
* ``functions`` - column expressions (time keys, text keys, packed records, schema helpers).
* ``operators`` - DataFrame -> DataFrame operators (filters, flights, weather,
  stations, features, routes, PageRank, statistics).
* ``plans``     - the query catalogue used by ``__spark_entry__`` and ``bench.py``.
"""

from runway.params import JobParams

__all__ = ["JobParams"]
