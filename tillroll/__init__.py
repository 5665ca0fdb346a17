"""tillroll: retail sales-mart jobs expressed as Spark DataFrame plans.

Every public function takes and returns DataFrames (or writes them); none
creates a SparkSession or does work at import time.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Tasks get the package's functions with the job, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
