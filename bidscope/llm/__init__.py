"""Training-data operators (token counts, dedup, decontamination, packing, ...).

Every operator is ``DataFrame -> DataFrame``.  The NumPy parts run inside
``mapInArrow`` tasks; importing this package tells cloudpickle to ship its
functions by value, so executors need only NumPy and PyArrow, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
