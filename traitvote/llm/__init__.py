"""Operators for training-data pipelines; nothing else in the library needs them."""

import sys

from pyspark import cloudpickle

from .oracles import ORACLES
from .queries import QUERIES

# Functions go to the executors with their code, so these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
