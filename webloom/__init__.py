"""webloom: web-document analytics as Spark table jobs.

Captured pages, HTTP responses and RSS/Atom feeds are rows; every job is a
DataFrame plan (generators, windows, joins, aggregates) built from
``pyspark.sql.functions`` only.
"""

__version__ = "0.1.0"
