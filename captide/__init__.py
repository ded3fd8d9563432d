"""Television caption corpora on Spark: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# Parsers travel to the executors inside the job, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
