"""Training-data operators over ``documents``, ``benchmark`` and ``embeddings``.

One module per operator; ``catalog`` registers their queries.  Nothing
outside this package imports it.  Functions that run in Python workers are
pickled by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
