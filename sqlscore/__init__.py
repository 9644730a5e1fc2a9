"""Distributed candidate-SQL scoring and evaluation on Spark.

Column functions live in :mod:`sqlscore.functions`, DataFrame transforms in
:mod:`sqlscore.operators`, table readers, fixtures and the SQL executor in
:mod:`sqlscore.sources`, the registered query plans in :mod:`sqlscore.plans`
and, optional, the training-data operators in a package of their own.
"""

__version__ = "0.1.0"
