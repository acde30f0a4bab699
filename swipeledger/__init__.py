"""Card and loan analytics as Spark jobs.

``schemas``    declared layouts of the tables
``functions``  column expressions (text, dates, money)
``sources``    JSON and parquet readers, temp views
``sinks``      parquet, JSON and JDBC writers
``operators``  DataFrame -> DataFrame: cleaning, joins, lookups, updates, reports
``plans``      jobs that write: the load of all tables, the publishing of edits

Every function takes the caller's session or DataFrames; none builds a session,
and only ``sinks`` and ``plans`` start Spark jobs.
"""
