"""Transaction cleaning and enrichment."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from spendlens.functions import exprs
from spendlens.operators import lookups, ordering

# neighbours are often of one project: what they share comes first, which packs best where rows move
MOVED = ("project_id", "invoice_ref", "approved_by", "currency", "transaction_id")
RANGE = "_range"  # of ids, by which stored transactions are dealt
UNASSIGNED = "Unassigned / Pending"  # fixed value


def _asked(rows: DataFrame, key: str, dim: DataFrame, dim_key: str, columns: Mapping[str, str]) -> tuple[list[str], DataFrame, str]:
    """A side of a dealt join: what the keys of every range have in ``dim``."""
    asked = rows.where(F.col(key).isNotNull()).select(RANGE, key).distinct()
    return [key], asked.join(lookups.unique_side(dim, key, dim_key, columns), key), "left"


def enrich_transactions(
    transactions: DataFrame, projects: DataFrame, employees: DataFrame, stored: bool = False
) -> DataFrame:
    """Typed amounts and dates, approval flag, project and approver names; one row in, one row out.

    ``stored`` transactions, which may be read several times, are dealt by ranges of their ids and move once for both names, if the
    result is computed within ``session.dealt_alike``.
    """
    day = exprs.as_date(transactions, "transaction_date")
    typed = (ordering.with_range(transactions, ["transaction_id"], RANGE) if stored else transactions).withColumns({
        "amount": exprs.zero_if_null(exprs.as_double(transactions, "amount")),
        "approved_by": exprs.blank_to_null(F.col("approved_by"), trim=False),
    }).select(*[RANGE] * stored, *MOVED, *[name for name in transactions.columns if name not in MOVED])
    approver = ("approved_by", employees, "employee_id", {"full_name": "approver_full_name"})
    project = ("project_id", projects, "project_id", {"project_name": "project_name", "department": "department"})
    if stored:
        named = lookups.dealt_join(typed, RANGE, [_asked(typed, *side) for side in (approver, project)])
    else:
        # the side that adds less comes first, as the second join moves what the first has added
        with_approver = lookups.left_lookup(typed, approver[1], approver[0], *approver[2:])
        named = lookups.left_lookup(with_approver, project[1], project[0], *project[2:])
    # what follows from other columns is added after the joins, which need not move it
    return named.withColumns({
        "transaction_date": exprs.iso_date(day),
        "transaction_year_month": exprs.year_month(day),
        "amount_aed": F.col("amount"),
        "is_approved": F.col("approved_by").isNotNull(),
        "approver_full_name": F.coalesce("approver_full_name", F.lit(UNASSIGNED)),
    }).select(
        *transactions.columns, "transaction_year_month", "amount_aed", "is_approved",
        "project_name", "department", "approver_full_name",
    )
