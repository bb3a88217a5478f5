"""Parameter-driven synthetic data as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# UDF bodies travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
