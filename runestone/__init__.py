"""runestone: multilingual text-corpus processing written as Spark jobs.

Corpora are DataFrames, cleaning and tagging are column expressions, profiles
and metrics are aggregations, samples and splits are exact hash cut-offs,
classifiers are Spark ML pipelines and live scoring is Structured Streaming.
"""

__version__ = "0.1.0"
