"""parityline: table reconciliation and run analytics as Spark jobs.

Functions of the package that run in Python workers travel with their tasks, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
