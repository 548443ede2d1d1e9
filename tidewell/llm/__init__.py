"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the job, so that a
# cluster needs no copy of it on its machines.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
