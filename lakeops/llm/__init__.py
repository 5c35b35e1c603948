"""Training-data operators (one module per operator) and their registered queries.

Nothing else in the library imports this subpackage.  Its functions are sent to
the executors by value, so a worker needs numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
