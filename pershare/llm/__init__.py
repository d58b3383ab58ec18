"""Operators of a training-data pipeline. Nothing outside this folder imports it.

The code of the Python steps travels with the tasks, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
