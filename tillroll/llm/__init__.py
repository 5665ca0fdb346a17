"""Training-data operators. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks get the package's functions with the job, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
