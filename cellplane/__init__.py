"""cellplane: overlay analytics over sparse cells and runs, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors whole, so those need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
