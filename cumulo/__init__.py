"""cumulo: Spark-native fact modelling and cumulative-table jobs.

Every job takes and returns DataFrames, names its columns through
parameters and runs on built-in Spark SQL expressions (no Python UDFs).
Sub-packages:

* ``sources``   – table readers, stand-in inputs, shared work folders
* ``functions`` – column expressions (bits, arrays, dates, text, maps)
* ``operators`` – the jobs (dedup, facts, cumulation, datelists, metrics,
                  SCD2, vertices, joins, rankings)
* ``plans``     – physical layout jobs and plan inspection helpers
* ``streaming`` – day-by-day incremental loaders
"""

__version__ = "0.1.0"
