"""Operators of a training-data pipeline.

Functions of this package that run in tasks are sent with them by value, so executors
need numpy, pyarrow and the like, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
