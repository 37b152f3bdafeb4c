"""retention_engine — PySpark operators for building, measuring and watching customer-risk rankings.

Every operator is a plain ``DataFrame -> DataFrame`` function. Nothing is collected to the driver
except bounded summaries (a fitted statistic per feature, a grid of at most a few hundred rows).
"""

__version__ = "0.1.0"
