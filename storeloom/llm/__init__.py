"""Operators of a large-scale training-data pipeline, with their registered queries.

Functions that run in tasks travel by value, so executors need not have this package installed.
"""

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["_"]))
