"""Operators of a training-data pipeline, each written for Spark.

Nothing outside this subpackage imports it. ``queries`` holds the registered
``opN_<name>`` queries and their SQL; ``corpus_pipeline.py`` at the repository
top chains five of the operators.
"""
