"""Page-level feature engineering and outcome prediction on Spark.

Operators are plain functions ``f(df, ...) -> DataFrame`` built from
DataFrame / Column expressions; see README.md for the operator map.
"""

__version__ = "0.1.0"
