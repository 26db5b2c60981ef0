"""quire: review analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; work runs on
executors, the driver only sees bounded results (scalars, a few rows).
"""

__version__ = "0.1.0"
