"""Statistics, model evaluation and model selection over Spark DataFrames."""

__version__ = "0.1.0"
