"""Preference-data analytics on PySpark DataFrames."""

import sys as _sys

import pyspark.cloudpickle as _cloudpickle

# Worker functions are shipped by value, so executors need PySpark, pandas and pyarrow only.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
