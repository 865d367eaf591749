"""scanlake: a PySpark engine for recorded port-scan results.

Every public operator takes and returns Spark DataFrames.  Modules:

* ``sources``   – readers for scanner output, resolution records, selectors,
                  XML/text report sets and flat CSV exports.
* ``functions`` – column expressions (IPv4 order key, subnets, URLs, XML escaping).
* ``operators`` – selections, groupings, domain enrichment, services, reports, graph.
* ``store``     – the versioned Parquet observation inventory.
* ``plans``     – the end-to-end flows (add, scan listing, report, parse, draw).
* ``streaming`` – the ingest flow over a landing folder with Structured Streaming.
"""

__version__ = "0.1.0"
