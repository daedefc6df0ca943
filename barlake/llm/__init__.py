"""Operators for preparing training text: personal data, source mixing, quality, near and exact duplicates,
subword encoding, page extraction, toxicity, secrets and language.

Nothing outside this package imports it. Every operator takes and returns DataFrames; numpy, Arrow and pure
Python run only inside tasks over bounded batches. Functions sent to tasks travel by value, so executors need the
third-party libraries but no copy of this package."""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
