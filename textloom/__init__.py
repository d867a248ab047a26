"""textloom: text-to-label dataset operators as Spark DataFrame transformations.

Every public operator takes DataFrames (plus named columns and parameters)
and returns a DataFrame; nothing is collected to the driver except bounded
parameter tables and scalar sizes.
"""

__version__ = "0.1.0"
