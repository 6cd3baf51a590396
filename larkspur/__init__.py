"""Analytics operators on Spark DataFrames.

Every function takes DataFrames and returns DataFrames (or fitted MLlib
models).  Nothing prints and nothing unbounded is collected to the driver.
"""

__version__ = "0.1.0"
