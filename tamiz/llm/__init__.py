"""Operators for training corpora: one module each, registered in ``workload``."""

import sys

from pyspark import cloudpickle

# Functions run on executors travel with the job, so the library need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
