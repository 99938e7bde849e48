"""Operators for preparing language-model training data.

Worker functions of this package are shipped to the executors by value, so executors need
only PySpark, numpy, pandas and pyarrow.
"""

import pyspark.cloudpickle as _cloudpickle

import pairloom

_cloudpickle.register_pickle_by_value(pairloom)
