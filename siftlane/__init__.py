"""siftlane: rule-list compilation and record analytics on Spark.

The core (everything but :mod:`siftlane.llm`) compiles many rule lists into one
consistent rule set with DataFrame operators. The ``llm`` subpackage holds the
operators for training data; nothing outside of it imports it.
"""

__version__ = "0.1.0"
