"""Operators for preparing large text corpora, and their registered queries."""

import sys

from pyspark import cloudpickle

# Python workers get this package's functions with the job, so it need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
