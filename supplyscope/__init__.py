"""supplyscope: supply-chain analytics as Spark DataFrame jobs.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects
(plus plain parameters).  Nothing collects data to the driver; Catalyst and
AQE choose the physical plan.
"""

__version__ = "0.1.0"
