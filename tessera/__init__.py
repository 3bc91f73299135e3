"""tessera: layered registration analytics as Spark DataFrame jobs.

Every public operator takes and returns DataFrames and is built from
built-in Spark expressions, so Catalyst can push filters and prune
columns through it and the work stays inside whole-stage codegen.
"""

__version__ = "0.1.0"
