"""ubeat — user-behaviour event analytics on Spark.

Every operator is a lazy DataFrame -> DataFrame transformation.  Batch
operators run on any DataFrame; the ``ubeat.streaming`` module holds the
Structured Streaming forms of the stateful ones.
"""

from ubeat.session import get_session

__all__ = ["get_session"]
