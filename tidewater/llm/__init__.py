"""Training-data operators and the queries that apply them.

Nothing outside this package imports it, except the guarded lookup in
``__spark_entry__.py``. Functions that run in Python workers are shipped by
value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
