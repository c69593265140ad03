"""Operators of a training-data pipeline over text corpora, one module per operator.

Nothing outside this package imports it. ``queries`` registers one query per operator
and the pipeline; every operator is a ``DataFrame -> DataFrame`` function on its own.
"""
