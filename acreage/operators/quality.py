"""Rule checks: failures as rows, and the rows that pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.columns import all_present, any_of, named, row_as_text
from acreage.operators.changes import lookup_join
from acreage.operators.keys import dense_surrogate_key, number
from acreage.sources.writers import Lake, stored

MODES = ("filter", "stat", "filter_and_stat")
# The rules' names and the texts of their failures.
RULE_TYPES = ("not_null", "unique", "value_range", "allowed_values")
NULL_TEXT = "Null in column {column}"
DUPLICATE_TEXT = "Duplicate on {columns}"
RANGE_TEXT = "Value outside range [{low}, {high}]"
DISALLOWED_TEXT = "Disallowed value in column {column}"

FAILURE_COLUMNS = [
    "rule_type",
    "failed_col_nm",
    "failed_col_value",
    "failed_record_detail",
    "failed_record",
]


def _failure(rule_type: str, column: str, value: Column, detail: str) -> Column:
    return F.struct(
        F.lit(rule_type).alias("rule_type"),
        F.lit(column).alias("failed_col_nm"),
        value.alias("failed_col_value"),
        F.lit(detail).alias("failed_record_detail"),
    )


def _row_checks(rule: Mapping) -> list[tuple[Column, Column]]:
    """(fails, failure) for each column a row rule looks at. NULL fails only ``not_null``."""
    kind = rule["rule_type"]
    if kind == "not_null":
        return [
            (
                named(c).isNull(),
                _failure(kind, c, F.lit(None).cast("string"), NULL_TEXT.format(column=c)),
            )
            for c in rule["columns"]
        ]
    column = rule["column"]
    value, text = named(column), named(column).cast("string")
    if kind == "value_range":
        low, high = rule["min"], rule["max"]
        detail = RANGE_TEXT.format(low=low, high=high)
        return [((value < low) | (value > high), _failure(kind, column, text, detail))]
    allowed = rule["allowed_values"]
    return [(~value.isin(*allowed), _failure(kind, column, text, DISALLOWED_TEXT.format(column=column)))]


def _row_failures(df: DataFrame, rules: Sequence[Mapping], pk: str) -> DataFrame:
    """All row rules in one pass: a row that fails any of them yields an array of failures."""
    checks = [check for rule in rules for check in _row_checks(rule)]
    found = F.array_compact(F.array(*[F.when(fails, failure) for fails, failure in checks]))
    return (
        df.where(any_of([F.coalesce(fails, F.lit(False)) for fails, _ in checks]))
        .select(named(pk), row_as_text(df.columns).alias("failed_record"), F.explode(found).alias("_f"))
        .select(pk, "_f.*", "failed_record")
    )


def duplicated_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once. Keys with a NULL are never duplicates.

    Keys are counted before the shuffle and joined back, so the rows of one key need not meet
    in one task.
    """
    whole = df.where(all_present(columns))
    repeated = whole.groupBy(*columns).count().where(F.col("count") > 1).select(*columns)
    return lookup_join(whole, repeated, list(columns), "left_semi").select(*df.columns)


def _unique_failures(df: DataFrame, rule: Mapping, pk: str) -> DataFrame:
    columns = list(rule["columns"])
    failure = _failure(
        "unique",
        ",".join(columns),
        F.concat_ws(",", *[named(c).cast("string") for c in columns]),
        DUPLICATE_TEXT.format(columns=columns),
    )
    return duplicated_rows(df, columns).select(
        named(pk), failure.alias("_f"), row_as_text(df.columns).alias("failed_record")
    ).select(pk, "_f.*", "failed_record")


def find_failures(df: DataFrame, rules: Sequence[Mapping], pk: str) -> DataFrame:
    """One row per row and failed check: the key, the rule, the value and the whole record."""
    for rule in rules:
        if rule.get("rule_type") not in RULE_TYPES:
            raise ValueError(f"unknown rule type: {rule.get('rule_type')}")
    row_rules = [r for r in rules if r["rule_type"] != "unique"]
    parts = [_row_failures(df, row_rules, pk)] if row_rules else []
    parts += [_unique_failures(df, r, pk) for r in rules if r["rule_type"] == "unique"]
    if not parts:
        raise ValueError("no rules given")
    failures = parts[0]
    for part in parts[1:]:
        failures = failures.unionByName(part)
    return failures.select(pk, *FAILURE_COLUMNS)


def passing_rows(df: DataFrame, failures: DataFrame, pk: str) -> DataFrame:
    """Rows whose key has no failure."""
    return lookup_join(df, failures.select(pk).distinct(), [pk], "left_anti").select(*df.columns)


def quarantine(failures: DataFrame, table: str, as_of: date, base: int, pk: str) -> DataFrame:
    """Failures as rows of the bad-record table, with keys following ``base`` in order of the rows."""
    numbered = dense_surrogate_key(failures, "brnz_bd_rec_sk", base, [pk, *FAILURE_COLUMNS])
    return bad_record_rows(numbered, table, as_of, pk)


def bad_record_rows(numbered: DataFrame, table: str, as_of: date, pk: str) -> DataFrame:
    return numbered.select(
        "brnz_bd_rec_sk",
        F.lit(table).alias("tbl_nm"),
        pk,
        "failed_col_nm",
        "rule_type",
        "failed_record_detail",
        "failed_col_value",
        "failed_record",
        F.lit(as_of).alias("load_date"),
        F.lit(as_of).cast("timestamp").alias("load_date_ts"),
    )


def check_quality(
    df: DataFrame,
    rules: Sequence[Mapping],
    table: str,
    pk: str,
    mode: str = "filter",
    *,
    as_of: date | None = None,
    bad_records: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Check ``df`` and return what to go on with and the failures.

    ``filter`` returns passing rows; ``stat`` appends failures, without the key column, to the
    parquet table ``bad_records`` and returns all rows; ``filter_and_stat`` does both. Their keys
    follow the largest in the table, which is part of a folder's name there: the table is not read.
    It is one writer's at a time. Failures are found and stored once, when this is called.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    if mode != "filter" and (bad_records is None or as_of is None):
        raise ValueError(f"mode {mode} needs bad_records and as_of")
    failures = stored(find_failures(df, rules, pk))
    if mode != "filter":
        root, _, name = bad_records.rstrip("/").rpartition("/")
        store = Lake(df.sparkSession, root)
        numbered = number(failures, "brnz_bd_rec_sk", store.marks(name).get("top_nr", 0))
        rows = bad_record_rows(numbered.rows, table, as_of, pk).drop(pk)
        store.append(name, rows, rows.schema, {"top_nr": numbered.top})
        numbered.discard()
    return (df if mode == "stat" else passing_rows(df, failures, pk)), failures
