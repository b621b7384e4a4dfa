"""tidewatch: time-series sentiment analytics on Spark.

Panels of observations per symbol become returns, moving averages and
cross-symbol ratios; periods are labelled by thresholds on a target
series; feature sets are versioned in a registry; models are trained and
ranked with MLlib; new data is checked for drift and quality, in batch and
in windowed streams.  Everything is expressed with DataFrames so Catalyst
plans it and the work is partitioned across the cluster.
"""

__version__ = "0.1.0"
