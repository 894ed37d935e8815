"""Spark jobs for comparing the quality of many single-cell sequencing datasets."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
