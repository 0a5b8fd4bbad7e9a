"""Explicit schemas of the raw (bronze) sources: every read passes one.

Dates are epoch seconds (long) and money is double, as the raw files carry
them; ``readers`` converts both once, at the silver boundary.
"""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


L, S, D, B = LongType(), StringType(), DoubleType(), BooleanType()

COA = _s(("coa_id", L), ("cost_center_id", L), ("cost_center_name", S), ("legal_entity_id", L),
         ("legal_entity_name", S))
THIRD_PARTIES = _s(("third_party_id", L), ("third_party_name", S))
CUSTOMERS = _s(("customer_id", L), ("third_party_id", L), ("customer_name", S), ("customer_industry", S))
SUPPLIERS = _s(("supplier_id", L), ("third_party_id", L), ("supplier_name", S))
EMPLOYEES = _s(("employee_id", L), ("employee_name", S), ("salary", D), ("cost_center_id", S),
               ("legal_entity_id", L), ("hire_date", L))
_CONTRACT = [("contract_id", L), ("contract_number", S), ("legal_entity_id", L), ("contract_currency", S),
             ("total_contract_value", D), ("contract_start_date", L), ("estimated_completion_date", L),
             ("contract_status", S), ("contract_type", S), ("contract_description", S), ("payment_terms", S)]
OUTBOUND_CONTRACTS = _s(*_CONTRACT[:2], ("customer_id", L), *_CONTRACT[2:], ("project_id", L))
INBOUND_CONTRACTS = _s(*_CONTRACT[:2], ("supplier_id", L), *_CONTRACT[2:])
REVENUE_TRANSACTIONS = _s(("rev_trx_id", L), ("contract_id", L), ("customer_id", L), ("transaction_date", L),
                          ("coa_id", L), ("cost_category", S), ("amount", D))
REVENUE_BILLINGS = _s(("billing_id", L), ("rev_trx_id", L), ("invoice_date", L), ("invoice_number", S),
                      ("billed_amount", D), ("payment_due_date", L), ("payment_received_date", L),
                      ("retention_amount", D))
PURCHASE_ORDERS = _s(("purchase_order_id", L), ("contract_id", L), ("purchase_order_number", S),
                     ("purchase_order_date", L), ("purchase_order_status", S), ("supplier_id", L),
                     ("purchase_order_currency", S), ("purchase_order_amount", D),
                     ("total_purchase_order_value", D), ("coa_id", L))
SPEND_INVOICES = _s(("invoice_id", L), ("purchase_order_id", L), ("invoice_number", S), ("invoice_date", L),
                    ("invoice_status", S), ("invoice_amount", D), ("tax_amount", D), ("discount_amount", D),
                    ("total_invoice_amount", D), ("amount_paid", D), ("payment_due_date", L),
                    ("invoice_category", S), ("payment_date", L), ("payment_method", S),
                    ("payment_reference", S), ("receipt_matched", B), ("three_way_match_status", S),
                    ("goods_received_date", L))

# Which columns are epoch instants and which are money, per source.
EPOCH_COLS = {
    "employees": ["hire_date"],
    "outbound_contracts": ["contract_start_date", "estimated_completion_date"],
    "inbound_contracts": ["contract_start_date", "estimated_completion_date"],
    "revenue_transactions": ["transaction_date"],
    "revenue_billings": ["invoice_date", "payment_due_date", "payment_received_date"],
    "purchase_orders": ["purchase_order_date"],
    "spend_invoices": ["invoice_date", "payment_due_date", "payment_date", "goods_received_date"],
}
MONEY_COLS = {
    "employees": ["salary"],
    "outbound_contracts": ["total_contract_value"],
    "inbound_contracts": ["total_contract_value"],
    "revenue_transactions": ["amount"],
    "revenue_billings": ["billed_amount", "retention_amount"],
    "purchase_orders": ["purchase_order_amount", "total_purchase_order_value"],
    "spend_invoices": ["invoice_amount", "tax_amount", "discount_amount", "total_invoice_amount", "amount_paid"],
}
SCHEMAS = {
    "coa": COA, "third_parties": THIRD_PARTIES, "customers": CUSTOMERS, "suppliers": SUPPLIERS,
    "employees": EMPLOYEES, "outbound_contracts": OUTBOUND_CONTRACTS, "inbound_contracts": INBOUND_CONTRACTS,
    "revenue_transactions": REVENUE_TRANSACTIONS, "revenue_billings": REVENUE_BILLINGS,
    "purchase_orders": PURCHASE_ORDERS, "spend_invoices": SPEND_INVOICES,
}
