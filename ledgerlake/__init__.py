"""ledgerlake: company-register and annual-accounts analytics on Spark.

Every operator takes and returns DataFrames (or Columns) and is built from
built-in Spark SQL expressions, joins, aggregations and windows.  Nothing
here collects data to the driver.
"""

__version__ = "0.1.0"
