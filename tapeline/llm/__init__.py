"""Operators of a training-data pipeline. Nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with their modules: a cluster needs the installed libraries, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
