"""Training-data operators: ten stand-alone jobs over documents, pages and benchmark tables.

Functions that run inside tasks are shipped by value, so executors need not
have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
