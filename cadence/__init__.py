"""Activity marts on PySpark: dedup, local time, sessions, day publication, marts.

Modules: ``schema`` (fixed values, schemas), ``session`` (session contract),
``functions`` (column expressions), ``sources`` (readers), ``operators``
(dedup, sessions, marts, serving, quality), ``plans`` (transform, jobs),
``sinks`` (publication), ``streaming`` (Structured Streaming variants).
"""

__version__ = "0.1.0"
