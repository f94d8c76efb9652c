"""Nested columns of investment documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.schemas import XML_INVESTORS, XML_RETURNS


def parse_nested(df: DataFrame) -> DataFrame:
    """Give the nested columns of documents their declared layout, if they have another.

    Documents read with ``XML_DOCUMENT`` have it. Of inferred ones fields are matched by name
    through JSON, so it does not matter in which order or with which number types they were
    inferred.
    """

    def declared(name: str, layout: T.DataType) -> Column:
        return F.col(name) if df.schema[name].dataType == layout else F.from_json(F.to_json(name), layout)

    return df.withColumns(
        {
            "investors_array": declared("Investors", XML_INVESTORS),
            "returns_array": declared("Returns", XML_RETURNS),
        }
    )
