"""Engine table schemas.

Balances and prices are DECIMAL(38,18); products of two of them are taken in DOUBLE, because
Spark would shrink the scale of a DECIMAL(38,18) product to 6 digits.
"""

AMOUNT = "decimal(38,18)"

EVENT_LOG = (
    "chain STRING, address STRING, block_number BIGINT, removed BOOLEAN, transaction_hash STRING, "
    "log_index BIGINT, topics ARRAY<STRING>, data STRING"
)
