"""tillwright: retail analytics as Spark DataFrame jobs.

Sub-packages:

* ``sources``   readers and writers
* ``functions`` column expressions (normalisation, hashing, lookups, dates)
* ``operators`` reusable DataFrame operators (ingest steps, ordered sums, interval joins, checks)
* ``plans``     the analytical views, the derived tables and the registered queries
* ``streaming`` the same jobs under Structured Streaming
"""
