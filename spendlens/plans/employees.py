"""Employee cleaning: set-based repairs with audit flags."""

from pyspark.sql import Column, DataFrame, functions as F

from spendlens.functions import exprs
from spendlens.operators import dedup, ordering, stats
from spendlens.session import materialize

CANONICAL_COLUMNS = (
    "employee_id", "full_name", "email", "department", "role", "level", "hire_date",
    "salary", "manager_id", "region", "status", "years_experience",
)
FLAGS = (
    "dq_missing_email", "dq_invalid_hire_date", "dq_negative_experience", "dq_self_manager",
    "dq_salary_outlier", "dq_status_conflict",
)
ROOT_MANAGER = "EMP0000"  # fixed value
EARLIEST_HIRE = "1990-01-01"  # fixed value
JUNIOR_SALARY_LIMIT = 50_000  # fixed value
DEFAULT_DOMAIN = "example.com"


def _local_parts(emails: DataFrame, domain: str) -> DataFrame:
    """Taken addresses of the domain as (base, suffix), one row per way to split the digits off."""
    local = F.substring_index("address", "@", 1)
    digits = F.length(F.regexp_extract(local, r"([0-9]{0,18})$", 1))
    cuts = F.explode(F.sequence(F.lit(0), digits))
    size = F.length("local")
    return (
        emails.where(F.substring_index("address", "@", -1) == domain)
        .select(local.alias("local"), cuts.alias("cut"))
        .select(
            F.substring("local", F.lit(1), size - F.col("cut")).alias("_base"),
            F.substring("local", size - F.col("cut") + 1, F.col("cut")).alias("tail"),
        )
        .where((F.col("tail") == "") | F.col("tail").rlike("^[1-9]"))
        .select(
            "_base", F.when(F.col("tail") == "", F.lit(0).cast("bigint"))
            .otherwise(F.col("tail").try_cast("bigint")).alias("_suffix"),
        )
    )


def fill_emails(
    df: DataFrame,
    domain: str = DEFAULT_DOMAIN,
    order: tuple[str, ...] = ("employee_id",),
    id_fallback: bool = True,
    missing: Column | None = None,
) -> DataFrame:
    """Give every row without an email the first free ``first.last[n]`` address.

    The r-th missing row of a base name gets the r-th suffix that no existing address uses.
    With the used suffixes u(0) < u(1) < ... placed at u(j) - j and the missing rows at
    0, 1, 2, ..., that suffix is the row's place in the merged order of both, less one. Two
    numberings do it, over which a name's rows may be spread across many tasks.
    """
    if missing is None:
        missing = exprs.is_blank(F.col("email"))
    present = df.where(~missing)
    base = exprs.email_base(F.col("full_name"))
    if id_fallback:
        base = F.when(base == "", F.concat(F.lit("employee_"), F.lower("employee_id"))).otherwise(base)
    # the few rows to repair are stored: both numberings read them
    wanted = materialize(df.where(missing).withColumn("_base", base), "missing-emails")
    if wanted.isEmpty():
        return df

    addresses = present.select(F.lower(F.trim("email")).alias("address"))
    taken = _local_parts(addresses, domain)
    if id_fallback:
        # addresses made of an id end in digits: keep generated suffixes away from them
        reserved = wanted.where(F.col("_base").startswith("employee_")).select(
            F.concat(F.col("_base"), F.lit(f"@{domain}")).alias("address")
        )
        taken = taken.unionByName(_local_parts(reserved, domain).where("_suffix > 0"))
    # a stored side has a known size: it is broadcast if small, else the skew join can split
    bases = materialize(wanted.select("_base").distinct(), "email-bases")
    taken = taken.distinct().join(bases, "_base", "left_semi")

    members = wanted.withColumns({"_kind": F.lit(1), "_suffix": F.lit(None).cast("bigint")}).unionByName(
        taken.withColumn("_kind", F.lit(0)), allowMissingColumns=True
    )
    input_order = [*order, *[name for name in df.columns if name not in order]]
    numbered = ordering.number_in_groups(members, ["_base", "_kind"], ["_suffix", *input_order], "_n")
    merged = numbered.withColumn(
        "_slot", F.when(F.col("_kind") == 0, F.col("_suffix") - (F.col("_n") - 1)).otherwise(F.col("_n") - 1)
    )
    placed = ordering.number_in_groups(merged, ["_base"], ["_slot", "_kind", "_n"], "_m").where("_kind = 1")
    number = F.when(F.col("_m") > 1, (F.col("_m") - 1).cast("string")).otherwise("")
    filled = placed.withColumn("email", F.concat(F.col("_base"), number, F.lit(f"@{domain}")))
    return present.unionByName(materialize(filled.select(*df.columns), "filled-emails"))


def employee_flags(df: DataFrame, as_of: Column, earliest: str = EARLIEST_HIRE) -> DataFrame:
    """Parsed hire date and experience next to the audit flags, before any repair."""
    parsed = exprs.as_date(df, "hire_date")
    experience = exprs.as_double(df, "years_experience")
    salary = exprs.as_double(df, "salary")
    unparsed = parsed.isNull() & F.col("hire_date").isNotNull()
    implausible = exprs.flag(exprs.implausible_date(parsed, as_of, earliest))
    return df.withColumns({
        "_hired": parsed,
        "_implausible": implausible,
        "_unparsed": unparsed,
        "_experience": experience,
        "dq_missing_email": exprs.is_blank(F.col("email")),
        "dq_invalid_hire_date": unparsed | implausible,
        "dq_negative_experience": exprs.flag(experience < 0),
        "dq_self_manager": exprs.flag(F.col("employee_id") == F.col("manager_id")),
        "dq_salary_outlier": exprs.flag((F.col("level") == "Junior") & (salary > JUNIOR_SALARY_LIMIT)),
        "dq_status_conflict": F.lit(False),
    })


def _as_of(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def clean_employees(
    df: DataFrame,
    domain: str = DEFAULT_DOMAIN,
    as_of: str | None = None,
    order: tuple[str, ...] = ("employee_id",),
    keep_flags: bool = False,
    id_fallback: bool = True,
    status_rules: tuple[str, ...] = (),
    earliest: str = EARLIEST_HIRE,
) -> DataFrame:
    """The 12 canonical columns with emails, hire dates, experience, managers and salaries repaired.

    ``status_rules`` are boolean SQL expressions that mark a status conflict; none by default.
    """
    flagged = employee_flags(df, _as_of(as_of), earliest)
    conflict = F.lit(False)
    for rule in status_rules:
        conflict |= exprs.flag(F.expr(rule))
    # stored once: both medians, the email numbering and the repairs read it
    flagged = materialize(flagged.withColumn("dq_status_conflict", conflict), "flagged-employees")
    # the medians see all parsed dates and all Junior salaries, before any repair
    middle_day = stats.median_day(flagged, "_hired").scalar()
    juniors = flagged.where("level = 'Junior'").select(exprs.as_double(flagged, "salary").alias("salary"))
    junior_salary = (
        stats.exact_median(juniors, "salary").select(F.floor("median").alias("median")).scalar()
    )
    hired = F.when(F.col("_hired").isNull() | F.col("_implausible"), middle_day).otherwise(F.col("_hired"))
    salary_type = df.schema["salary"].dataType
    filled = fill_emails(flagged, domain, order, id_fallback, missing=F.col("dq_missing_email"))
    repaired = filled.withColumns({
        "hire_date": exprs.iso_date(hired),
        "years_experience": exprs.zero_if_null(F.abs("_experience")).try_cast("int"),
        "manager_id": F.when(F.col("dq_self_manager"), ROOT_MANAGER).otherwise(F.col("manager_id")),
        "salary": F.when(F.col("dq_salary_outlier"), junior_salary.cast(salary_type)).otherwise(F.col("salary")),
    })
    unique = dedup.keep_first(repaired, ["employee_id"], [name for name in order if name != "employee_id"])
    return unique.select(*CANONICAL_COLUMNS, *(FLAGS if keep_flags else ()))


def employee_issues(df: DataFrame, as_of: str | None = None, earliest: str = EARLIEST_HIRE) -> DataFrame:
    """(issue, row_count) for the seven repairs of :func:`clean_employees`."""
    flagged = employee_flags(df, _as_of(as_of), earliest)
    extra_ids = (
        df.groupBy("employee_id").agg((F.count("*") - 1).alias("extra"))
        .agg(exprs.zero_if_null(F.sum("extra"), "bigint").alias("extra"))
    )
    counted = flagged.agg(
        F.count_if("dq_missing_email").alias("missing_emails"),
        F.count_if("_unparsed").alias("invalid_hire_dates"),
        F.count_if("_implausible").alias("implausible_hire_dates"),
        F.count_if("dq_negative_experience").alias("negative_years_experience"),
        F.count_if("dq_self_manager").alias("employee_is_own_manager"),
        F.count_if("dq_salary_outlier").alias("salary_level_mismatches"),
    ).withColumn("duplicate_employee_ids", extra_ids.scalar())
    return stats.unpivot_counts(counted, "issue", "row_count")
