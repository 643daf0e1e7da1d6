"""Operators of a training-data pipeline: mixing, secret scan, language-model
scoring, fingerprints, near-duplicates, tokenisation, language, toxicity and
quality. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so that executors
# need numpy and pyarrow but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
