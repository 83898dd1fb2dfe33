"""Data work around machine-learning models, as Spark jobs.

Operators take and return DataFrames.  Only weights, class dictionaries whose
size is checked and one-row statistics reach the driver.
"""

import sys

from pyspark import cloudpickle

# Functions handed to Python workers travel with the task, so a cluster needs
# no copy of this package on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
