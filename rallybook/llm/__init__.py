"""Operators for large text corpora.

Functions that run in tasks travel with their job, so executors need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
