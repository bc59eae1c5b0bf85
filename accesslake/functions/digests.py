"""Content digests."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha2_256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


@F.pandas_udf(T.StringType())
def _sha3(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else hashlib.sha3_256(b).hexdigest())


def sha3_256(content: Column) -> Column:
    """SHA3-256 as hex. Spark has no built-in for it, hence the Arrow UDF."""
    return _sha3(content.cast("binary"))
