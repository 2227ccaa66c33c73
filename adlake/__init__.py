"""adlake: a PySpark-native marketing, commerce, web and survey warehouse.

Every operator is a plain function from DataFrames (and a few scalar
parameters) to a DataFrame. Nothing is collected to the driver; the driver
only builds Catalyst plans.
"""

from adlake.session import Window, get_session, checkpoint_dir

__all__ = ["Window", "get_session", "checkpoint_dir"]
