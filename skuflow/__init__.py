"""skuflow: Spark-native inventory, order and procurement analytics.

Every operator is a function from lazy DataFrames to a lazy DataFrame; nothing
is computed until the caller acts on the result.  ``skuflow.sources.tpch.bind``
derives the seven-table operational model from the driver's TPC-H-like tables,
``skuflow.registry`` exposes every operator by name.
"""

__version__ = "0.1.0"
