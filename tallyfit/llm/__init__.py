"""Operators for preparing training corpora: near copies, scoring, extraction, mixing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, which need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
