"""affinity: pairwise-connectivity analytics on Spark.

A weighted edge table scores how strongly every two units are connected;
small unit tables carry attributes.  Everything here is DataFrame in,
DataFrame out, built from Spark SQL / MLlib primitives so Catalyst plans
the work and the cluster does it.
"""

__version__ = "0.1.0"
