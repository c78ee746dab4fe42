"""Quality measures for public-transport real-time data, as Spark jobs.

Every operator is a plain function from DataFrames to a DataFrame. Reference
dates are arguments (``as_of``), never the clock, so results can be repeated.
"""

__version__ = "0.1.0"
