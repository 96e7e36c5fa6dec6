"""Time stamps as text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def iso_timestamp(ts) -> Column:
    """ISO 8601 text in the session's zone; a fraction is shown only if there is one."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_trunc("second", ts) == ts
    return F.when(whole, F.date_format(ts, _SECONDS)).otherwise(
        F.date_format(ts, _SECONDS + ".SSSSSS")
    )
