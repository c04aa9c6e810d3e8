"""Operators of a training-data pipeline: dedup, decontamination, extraction, filters, packing.

Each operator is a module of its own with a general interface on DataFrames;
``queries`` binds them to the given tables. Nothing else in the library
imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors with the job itself,
# so a cluster needs no copy of the library on its workers
cloudpickle.register_pickle_by_value(sys.modules[__name__])
