"""Marketplace analytics as plain DataFrame functions on Apache Spark.

Layers, from the bottom up:

* ``functions``  column helpers (null order, rounding rules, JSON, hashing)
* ``plans``      plan shapes reused by operators: size checks, split windows,
                 staging, versioned keyed tables, cached reports
* ``sources``    table, CSV, document, event and outbox readers and the sinks
* ``operators``  joins, reports, rankings, documents, graph, changes, quality,
                 rollups, generators -- each a function DataFrame(s) -> DataFrame
* ``streaming``  Structured Streaming jobs over the event envelope
* ``catalog``    every operator bound to the test tables, with its check SQL
"""
