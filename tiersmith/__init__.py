"""tiersmith: bronze / silver / gold retail order analytics as lazy Spark plans.

Every public transformation takes and returns a ``pyspark.sql.DataFrame`` and
is built from built-in Spark SQL expressions only, so Catalyst can prune,
push down and fuse the work.  Nothing is collected to the driver.
"""

__version__ = "0.1.0"
