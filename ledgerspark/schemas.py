"""Fixed source, silver and gold schemas. Every column is nullable.

Fixed values: column names, order and types are the data contract of the three layers.
"""

from pyspark.sql import types as T


def _schema(columns: str) -> T.StructType:
    """Works without a session, unlike DDL parsing."""
    schema = T.StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema.add(name, kind)
    return schema


CUSTOMERS = _schema(
    "customer_id string, name string, email string, phone string, address string, "
    "credit_score integer, join_date date, last_update timestamp, customer_type string"
)
BRANCHES = _schema(
    "branch_id string, branch_name string, location string, timezone string, currency string"
)
TRANSACTIONS = _schema(
    "transaction_id string, customer_id string, branch_id string, channel string, "
    "transaction_type string, amount double, currency string, timestamp string, status string"
)

SILVER_CUSTOMERS = _schema(
    "customer_id string, name string, email string, phone long, address string, "
    "credit_score integer, join_date date, last_update string, customer_type string, "
    "year integer, domain string, postal_code integer"
)
SILVER_BRANCHES = _schema(
    "branch_id string, branch_name string, location string, timezone string, currency string, "
    "latitude double, longitude double"
)
SILVER_TRANSACTIONS = _schema(
    "transaction_id string, customer_id string, branch_id string, channel string, "
    "transaction_type string, amount double, currency string, timestamp string, status string, "
    "year integer, month integer, Amount_USD double"
)

RATES = _schema("currency string, rate decimal(10,4)")
GAZETTEER = _schema("location string, latitude double, longitude double")

BRONZE_TABLES = {
    "customers_raw": CUSTOMERS,
    "branches_raw": BRANCHES,
    "transactions_raw": TRANSACTIONS,
}
SILVER_TABLES = {
    "cat_customers": SILVER_CUSTOMERS,
    "cat_branches": SILVER_BRANCHES,
    "cat_transactions": SILVER_TRANSACTIONS,
}
