"""Training-data operators: quality, toxicity, chat, near-duplicates, decontamination,
line and span dedup, personal data, similarity joins and sequence packing."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job: executors need not
# have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
