"""Keep analytics tables in step with their sources, with Spark doing the work.

``plans.sync.run_sync`` is the usual entry point; every step it takes is a
DataFrame or Column function from ``sources``, ``operators`` and ``functions``
that can be used alone.
"""
