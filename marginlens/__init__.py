"""marginlens: cohort-relative profitability analytics on Spark DataFrames.

Every operator is a pure ``DataFrame -> DataFrame`` function built from Spark
built-ins; I/O lives in :mod:`marginlens.sources` and :mod:`marginlens.sinks`.
"""

__version__ = "0.1.0"
