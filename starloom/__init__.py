"""starloom: star-schema lakehouse building blocks on PySpark DataFrames."""

__version__ = "0.1.0"
