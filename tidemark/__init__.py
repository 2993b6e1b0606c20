"""tidemark: incremental event analytics on Spark (Bronze -> Silver -> Gold).

Every operator is a ``DataFrame -> DataFrame`` function built from DataFrame /
SQL / Structured Streaming primitives.  Parameters that make a run
reproducible (``run_ts``, ``as_of``, ``top_n``, the type allow-list) are
explicit arguments; nothing reads a wall clock inside a plan.
"""

__version__ = "0.1.0"
