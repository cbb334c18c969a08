"""Credit-risk feature building, profiling, modelling and scoring on Spark DataFrames."""

__version__ = "0.1.0"
