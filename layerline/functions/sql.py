"""The library's functions for SQL text: plain expressions that Catalyst inlines, no Python in them."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name(parameters) and type, and the expression. Later ones may use earlier ones.
_FUNCTIONS = (
    # Weights 2 to 9 from the right, again and again; a remainder under 2 gives 0.
    ("mod11_sum(v STRING, n INT) RETURNS INT",
     "aggregate(sequence(1, n), 0, (s, i) -> s + coalesce(try_cast(substr(v, i, 1) AS INT), 0) * (2 + (n - i) % 8))"),
    ("mod11_digit(v STRING, n INT) RETURNS INT",
     "CASE WHEN mod11_sum(v, n) % 11 < 2 THEN 0 ELSE 11 - mod11_sum(v, n) % 11 END"),
    ("digits_only(v STRING) RETURNS STRING", "regexp_replace(v, '[^0-9]', '')"),
    ("is_valid_cnpj(v STRING) RETURNS BOOLEAN",
     "coalesce(v RLIKE '^[0-9]{14}$' AND v <> repeat(left(v, 1), 14)"
     " AND try_cast(substr(v, 13, 1) AS INT) = mod11_digit(v, 12)"
     " AND try_cast(substr(v, 14, 1) AS INT) = mod11_digit(v, 13), false)"),
    ("is_valid_access_key(v STRING) RETURNS BOOLEAN",
     "coalesce(v RLIKE '^[0-9]{44}$' AND try_cast(substr(v, 44, 1) AS INT) = mod11_digit(v, 43), false)"),
    ("safe_ratio(a DECIMAL(38, 4), b DECIMAL(38, 4)) RETURNS DECIMAL(38, 6)", "try_divide(a, nullif(b, 0))"),
    ("year_month(t TIMESTAMP_NTZ) RETURNS STRING", "date_format(t, 'yyyyMM')"),
    ("date_key(t TIMESTAMP_NTZ) RETURNS INT", "cast(date_format(t, 'yyyyMMdd') AS INT)"),
)


def register_functions(spark: SparkSession) -> list[str]:
    """Make the functions known to this session's SQL; gives their names. Done again, it changes nothing."""
    for head, body in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head, _ in _FUNCTIONS]
