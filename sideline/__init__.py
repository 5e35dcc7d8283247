"""sideline: incident and activity analytics as Spark DataFrame operators.

Layout
------
functions/   column expressions (text, dates, keys) and ordered rule classifiers
operators/   DataFrame -> DataFrame operators: schema repair, joins, stats, star schema
sources/     readers, sinks and input contracts
plans/       composite batch jobs and the views derived from the test tables
streaming/   the daily incremental run as a Structured Streaming query
"""

__version__ = "0.1.0"
