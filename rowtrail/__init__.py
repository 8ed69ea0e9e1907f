"""Change-history engine on Spark DataFrames.

Ordered feeds of row changes (insert, update, delete with before and after images) become one
searchable history row per change; on top of it sit search, reconciliation, retention and
fleet-wide capture-table operations. Every operator is a function from DataFrames to DataFrames.
"""

__version__ = "0.1.0"
