"""G2 dim_all_contracts: outbound and inbound contracts with party and entity names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.parties import party_by_role

# Columns both contract kinds share (the reference's templated column list).
CONTRACT_COLS = [
    "contract_id", "contract_number", "legal_entity_id", "contract_currency", "total_contract_value",
    "contract_start_date", "estimated_completion_date", "contract_status", "contract_type",
    "contract_description", "payment_terms",
]

OUTPUT_COLS = [
    "contract_id", "contract_number", "third_party_id", "third_party_name", "agreement_type",
    "contract_type", "contract_description", "contract_currency", "total_contract_value",
    "contract_start_date", "estimated_completion_date", "contract_status", "legal_entity_id",
    "legal_entity_name", "payment_terms",
]


def legal_entities(coa: DataFrame) -> DataFrame:
    """Distinct (legal_entity_id, legal_entity_name) of the account hierarchy."""
    return coa.select("legal_entity_id", "legal_entity_name").distinct()


def dim_all_contracts(outbound: DataFrame, inbound: DataFrame, party: DataFrame, coa: DataFrame) -> DataFrame:
    out = (outbound.join(party_by_role(party, "customer_id"), "customer_id", "left")
           .select(*CONTRACT_COLS, F.lit("Outbound").alias("agreement_type"), "third_party_id",
                   "third_party_name"))
    inb = (inbound.join(party_by_role(party, "supplier_id"), "supplier_id", "left")
           .select(*CONTRACT_COLS, F.lit("Inbound").alias("agreement_type"), "third_party_id",
                   "third_party_name"))
    base = out.unionByName(inb)
    return (base.join(legal_entities(coa), "legal_entity_id", "left")
            .select(*OUTPUT_COLS)
            .withColumn("contract_start_date", F.to_date("contract_start_date"))
            .withColumn("estimated_completion_date", F.to_date("estimated_completion_date")))
