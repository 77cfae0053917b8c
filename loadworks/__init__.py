"""loadworks — warehouse-loading operators on Spark DataFrames.

Every operator is a function from DataFrames (plus plain parameters) to a
DataFrame.  Operators never collect rows to the driver and never run Python
per row: the work is expressed with Spark SQL functions, joins, aggregates and
windows, so Catalyst prunes, pushes down and plans it.

Sub-packages
------------
functions   scalar Column -> Column helpers (legacy ETL dialect mapped to Spark)
sources     file readers, sniffing, catalog scans, table sinks
operators   shaping, joins, apply (upsert & co.), SCD2, checks, audit,
            reconciliation, schema matching, corpus scans
plans       end-to-end load flows and the query recipes used by the tests
"""

__version__ = "0.1.0"
