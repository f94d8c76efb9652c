from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.schemas import ACTIVITY


def named(name: str) -> Column:
    """A top-level column, also when its name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.and_, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(operator.or_, conditions)


def all_present(columns: Sequence[str]) -> Column:
    return all_of([named(c).isNotNull() for c in columns])


def address_key(*, county: bool = False) -> Column:
    """``address/city/state[/county]/zip``; NULL if any part is NULL."""
    parts = ["prop_address_line_txt", "prop_city_nm", "prop_state_nm"]
    parts += ["prop_cnty_nm"] if county else []
    pieces = [F.col(parts[0])]
    for part in [*parts[1:], "prop_zip_cd"]:
        pieces += [F.lit("/"), F.col(part)]
    return F.concat(*pieces)


def iso_time(moment: Column) -> Column:
    """A timestamp as ISO 8601 text with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def months_back(day: Column, months: int) -> Column:
    """The same day ``months`` earlier, or the month's last day where there is no such day."""
    return F.add_months(day, -months)


def whole_baths(bathrooms: Column) -> Column:
    return F.ceil(bathrooms).cast("int")


def geo_quantize(degrees: Column) -> Column:
    """Six decimals, half up; NULL outside what ``decimal(9,6)`` holds."""
    return degrees.try_cast("decimal(9,6)")


def normal_code(code: Column) -> Column:
    """Event names come with blanks, stored codes with underscores."""
    return F.replace(F.upper(code), F.lit(" "), F.lit("_"))


def known_activity(status: Column) -> Column:
    return status.isin(*ACTIVITY)


def activity_flag(status: Column, sub_status: Column) -> Column:
    """Whether the sub-code is one the activity code accepts; false for anything unknown."""
    sub_status = normal_code(sub_status)
    accepted = any_of([(status == s) & sub_status.isin(*subs) for s, subs in ACTIVITY.items()])
    return F.coalesce(accepted, F.lit(False))


def amount_if(status: Column, wanted: str, amount: Column) -> Column:
    return F.when(status == wanted, amount).otherwise(F.lit(0.0))


def equity(value: Column, sale: Column) -> Column:
    return value - sale


def gross_yield(rent: Column, value: Column) -> Column:
    """A year's rent as a percentage of the value; NULL when there is no value."""
    return F.round(F.try_divide(rent * 12, value) * 100, 2)


def row_as_text(columns: Sequence[str]) -> Column:
    """The whole row as a JSON object of texts."""
    return F.to_json(F.struct(*[named(c).cast("string").alias(c) for c in columns]))


def row_hash(df: DataFrame) -> Column:
    """A value that spreads rows evenly and is the same whenever a task is run again. Columns
    with maps, which have no hash, are left out."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return F.xxhash64(*[named(c) for c, kind in kinds.items() if "map<" not in kind])
