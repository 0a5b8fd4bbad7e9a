"""G1 dim_third_party: parties with their supplier and customer roles."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dim_third_party(third_parties: DataFrame, suppliers: DataFrame, customers: DataFrame) -> DataFrame:
    """party LEFT JOIN supplier role LEFT JOIN customer role (one row per role pair)."""
    supp = suppliers.select("third_party_id", "supplier_id")
    cust = customers.select("third_party_id", "customer_id", "customer_industry")
    return (third_parties.join(supp, "third_party_id", "left")
            .join(cust, "third_party_id", "left")
            .select(*third_parties.columns, "supplier_id", "customer_id", "customer_industry"))


def party_by_role(party: DataFrame, role_col: str, name_col: str = "third_party_name") -> DataFrame:
    """role id -> (third_party_id, name), one row per role id.

    ``dim_third_party`` repeats a role id once per other role of the same
    party; the lookup is de-duplicated (hash aggregate on the three columns)
    so a join on the role never fans out.
    """
    return (party.where(party[role_col].isNotNull())
            .select(role_col, "third_party_id", party["third_party_name"].alias(name_col))
            .distinct())
