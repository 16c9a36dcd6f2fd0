"""Operators of a training-data pipeline, each built on Spark by one named
method.  Nothing outside this folder imports it."""
