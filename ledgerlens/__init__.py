"""ledgerlens: order and spend analytics as Spark DataFrame jobs.

Every public function maps DataFrames to DataFrames and keeps a leading
``company_id`` column, so one Spark job serves every tenant at once.
"""

__version__ = "0.1.0"
