"""slotwise — daily audience targeting and message personalisation on Spark.

Every operator is a function over DataFrames built from Spark's own
expressions, joins and windows; nothing runs row-at-a-time in Python and no
recipient data is collected to the driver.
"""

from slotwise.config import RunParams, Scope

__all__ = ["RunParams", "Scope"]
