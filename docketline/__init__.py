"""docketline: document-chronology jobs on Spark DataFrames."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# ship the package with the Python UDFs that use it (no --py-files needed)
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
