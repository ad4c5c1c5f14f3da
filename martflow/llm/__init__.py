"""Operators for preparing training data, and a pipeline of them. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel inside the tasks, so executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
