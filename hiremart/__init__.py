"""hiremart — a job-market warehouse (landing → ODS → star schema → marts) on Spark.

Every operator is a function from DataFrames to a DataFrame; Catalyst plans the
joins, AQE sizes the shuffles and decides broadcasts from runtime statistics.
"""

__version__ = "0.1.0"
