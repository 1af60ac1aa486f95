"""kestrel: Spark-native analytics operators.

Every public operator is a plain ``DataFrame -> DataFrame`` function built on
native Spark expressions, so Catalyst sees (and optimises) the whole plan.
Domains: traffic shares and pivots, fuzzy/phonetic record matching, GPS
tracking (cleaning, acceleration, nearest point of interest, driver KPIs,
streaming), maintenance history matching with lifetime classes, and log
supervision.
"""

__version__ = "0.1.0"
