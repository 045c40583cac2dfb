"""Supply-chain analytics and data-quality jobs on Spark DataFrames."""

__version__ = "0.1.0"
