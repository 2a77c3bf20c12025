"""Column expressions shared by all plans; everything stays inside whole-stage codegen."""

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# fixed values: texts that stand for "missing"
NULL_TOKENS = ("", "None", "nan")
FK_NULL_TOKENS = ("", "None", "nan", "NULL")

# fixed values: project status to reporting category
STATUS_CATEGORY = {
    "In Progress": "Active",
    "Completed": "Closed",
    "Not Started": "Pending",
    "On Hold": "Pending",
}


def as_double(df: DataFrame, name: str) -> Column:
    """Lenient numeric cast: text that is not a number becomes null."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return column.try_cast("double")
    return column.cast("double")


def as_decimal(df: DataFrame, name: str, target: T.DecimalType) -> Column:
    if df.schema[name].dataType == target:
        return F.col(name)
    return F.col(name).try_cast(target)


def as_int(df: DataFrame, name: str) -> Column:
    """Whole number truncated towards zero, null when the text is not a number."""
    return as_double(df, name).try_cast("int")


def as_date(df: DataFrame, name: str) -> Column:
    """Lenient ISO date: only a full ``yyyy-MM-dd`` parses."""
    data_type = df.schema[name].dataType
    if isinstance(data_type, T.DateType):
        return F.col(name)
    if isinstance(data_type, T.StringType):
        return F.try_to_date(F.trim(F.col(name)), "yyyy-MM-dd")
    return F.to_date(F.col(name))


def zero_if_null(column: Column, data_type: T.DataType | str = "double") -> Column:
    return F.coalesce(column, F.lit(0).cast(data_type))


def is_blank(column: Column) -> Column:
    return column.isNull() | (F.trim(column.cast("string")) == "")


def blank_to_null(column: Column, tokens: Iterable[str] = NULL_TOKENS, trim: bool = True) -> Column:
    """Null for the missing-value texts; the comparison may ignore surrounding blanks."""
    text = column.cast("string")
    probe = F.trim(text) if trim else text
    return F.when(~probe.isin(*tokens), text)


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100``, zero when there is no positive whole."""
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))


def share_pct(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` or null for a zero whole."""
    return F.lit(100) * part / F.nullif(whole, F.lit(0))


def lookup(column: Column, mapping: Mapping[str, str], default: str) -> Column:
    """Map lookup as a CASE chain, with a default for unknown and null keys."""
    chain = F
    for key, value in mapping.items():
        chain = chain.when(column == key, value)
    return chain.otherwise(default)


def title_case(column: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others.

    ``initcap`` only breaks words at spaces, so a marked space is put behind every other
    separator and taken out again.
    """
    marked = F.regexp_replace(column, r"([^\p{L} ])(?=\p{L})", "$1\u0001 ")
    return F.regexp_replace(F.initcap(marked), "\u0001 ", "")


def risk_level(priority: Column, over_budget: Column, utilisation_pct: Column) -> Column:
    return (
        F.when((priority == "Critical") | over_budget, "High")
        .when((priority == "High") | (utilisation_pct > 90), "Medium")
        .otherwise("Low")
    )


def implausible_date(column: Column, as_of: Column, earliest: str = "1990-01-01") -> Column:
    return (column < F.lit(earliest).cast("date")) | (column > as_of)


def email_base(full_name: Column) -> Column:
    """``first.last`` from a name, or the cleaned name when it has fewer than two words."""
    letters = F.regexp_replace(F.lower(full_name), r"[^\p{L}\p{Z}\s]", "")
    words = F.trim(F.regexp_replace(letters, r"[\p{Z}\s]+", " "))
    return F.coalesce(F.regexp_replace(words, r"^(\S+) (?:.* )?(\S+)$", "$1.$2"), F.lit(""))


def iso_date(column: Column) -> Column:
    """``yyyy-MM-dd`` text of a date."""
    return column.cast("date").cast("string")


def year_month(column: Column) -> Column:
    return F.substring(iso_date(column), 1, 7)


def date_key(column: Column) -> Column:
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def elapsed_hours(start: Column, end: Column) -> Column:
    return F.round((F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600.0, 2)


def flag(column: Column) -> Column:
    """Boolean audit flag: unknown counts as false."""
    return F.coalesce(column, F.lit(False))


def uniform(*keys: Column | str) -> Column:
    """Repeatable value in (0, 1] derived from the keys, the same on every task attempt."""
    bits = F.shiftrightunsigned(F.xxhash64(*keys), 11)
    return (bits + 1) / F.lit(float(2**53))


def gaussian(seed: int, *keys: Column | str) -> Column:
    """Repeatable standard normal value (Box-Muller on two hashed uniforms)."""
    u, v = uniform(F.lit(seed), *keys), uniform(F.lit(seed + 1), *keys)
    return F.sqrt(-2 * F.log(u)) * F.cos(v * (2 * 3.141592653589793))
