"""Operators for preparing training data: sharding, near-duplicate joins, mixing,
URL filters, toxicity, token counts, chat formatting, language id,
decontamination and embedding near-duplicates.  Nothing outside this
subpackage imports it."""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
