"""tillstar: a card-transaction star schema, its upkeep, checks and reports on Spark.

Every operator takes and returns DataFrames. Only `sources.tables` and the
builders in `plans.medallion` write anything.
"""

__version__ = "0.1.0"
