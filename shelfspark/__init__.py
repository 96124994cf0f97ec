"""shelfspark — retail sales analytics as Spark DataFrame operators.

Subpackages: ``sources`` (readers, writers, test-table bindings),
``functions`` (column expressions), ``operators`` (DataFrame → DataFrame
operators), ``plans`` (stage pipelines and the query catalog),
``streaming`` (incremental runs of the batch stages).
"""

__version__ = "0.1.0"
