"""Operators for training-data pipelines: one module per operator; ``queries`` applies them to the driver's tables.

Functions that run in tasks travel with the job, so executors need not have the library."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
