"""streamlake: batch and streaming table operators as plain PySpark functions.

Every operator is a ``DataFrame -> DataFrame`` function built on the
DataFrame/SQL API (and Structured Streaming where it has state), so
Catalyst can push filters and prune columns through it.
"""

__version__ = "0.1.0"
