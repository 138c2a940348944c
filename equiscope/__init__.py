"""equiscope: representation analytics over star-shaped award data on Spark.

Everything is a DataFrame transformation; nothing on the data path is
collected to the driver.  Entry points:

* :mod:`equiscope.plans.engine` -- the four parametrised representation
  queries plus catalog helpers (the public API).
* :mod:`equiscope.operators` -- building blocks (filters, subtotal grid,
  exact median, effect size, crosswalks, reshape, institution merge).
* :mod:`equiscope.functions` -- Column expressions (rates, transforms,
  z-scores / p-values, string normalisers).
* :mod:`equiscope.sources` -- readers, the driver-table binding, sinks.
* :mod:`equiscope.streaming` -- incremental ingestion of yearly files.
"""

__version__ = "0.1.0"
