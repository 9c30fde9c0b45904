"""Training-data operators (numbered as dealt) and their registered queries.

Functions that run in Python workers travel with the job, so executors need not
have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
