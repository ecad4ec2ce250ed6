"""textlane: text-classification analytics as Spark DataFrame operators.

Every public operator is a function ``DataFrame -> DataFrame`` built from
native Spark expressions, joins, aggregates, windows and MLlib stages.
"""

__version__ = "0.1.0"
