"""carepulse: service-demand analytics on Spark DataFrames.

Every public operator takes DataFrames (plus plain parameters such as an
explicit ``as_of`` date) and returns a DataFrame.  Nothing is collected to
the driver except bounded metadata (row-count probes capped with ``limit``).
"""

__version__ = "0.1.0"
