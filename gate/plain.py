"""Final projection of registered queries to plain comparable types."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """Decimals to rounded doubles, integers to bigint, dates and times to text."""
    picks = []
    for field in df.schema.fields:
        c = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, (T.ShortType, T.ByteType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.DecimalType):
            c = c.cast("double")
        elif isinstance(kind, (T.DoubleType, T.FloatType)) and digits is not None:
            c = F.round(c, digits)
        elif isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.ArrayType):
            c = F.concat_ws(",", c)
        picks.append(c.alias(field.name))
    return df.select(*picks)
