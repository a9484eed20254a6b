"""Operators for preparing text corpora.

The functions of this subpackage that run in Python workers travel with the
job, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
