"""Spark-native hand analytics, drift and monitoring engine.

Modules: ``functions.cards`` (row expressions), ``operators`` (ranks, equity,
features, relative, sampling, drift, monitor, model, runlog), ``sources``
(tables, derived tables, I/O), ``streaming.pipelines``, ``plans`` (registered
queries, jobs, command line). See README.md.
"""

__version__ = "0.1.0"
