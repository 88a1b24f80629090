"""servicelens: repair and service-order analytics as Spark DataFrame jobs.

Packages: ``sources`` (CSV and stage tables, driver-table views),
``functions`` (dates, working-day calendar, scalar helpers), ``operators``
(preparation, KPIs, rules, clusters, demand series), ``plans`` (registered
queries, oracle SQL, end-to-end runs), ``streaming`` (incremental ingest).
"""
