"""critiq: review analytics on Spark DataFrames.

Subpackages: ``sources`` (tables, readers, sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame operators), ``plans``
(registered queries and their SQL oracles), ``streaming`` (incremental ingest).
"""

__version__ = "0.1.0"
