"""Declared schemas. Nothing is inferred outside the explicit "explore" reader."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
MONEY, NTZ = T.DecimalType(18, 2), T.TimestampNTZType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column names and types below are fixed values: they are those of the files.

# Domain tables -------------------------------------------------------------
CUSTOMERS = struct(customer_id=STRING, customer_unique_id=STRING, customer_city=STRING, customer_state=STRING)
ORDERS = struct(order_id=STRING, customer_id=STRING, order_status=STRING, order_purchase_timestamp=NTZ)
PAYMENTS = struct(order_id=STRING, payment_type=STRING, payment_value=MONEY)
ITEMS = struct(order_id=STRING, order_item_id=INT, product_id=STRING, price=MONEY, freight_value=MONEY)
REVIEWS = struct(order_id=STRING, review_score=INT)
PRODUCTS = struct(product_id=STRING, product_category_name=STRING, product_weight_g=INT)

DOMAIN = {
    "customers": CUSTOMERS,
    "orders": ORDERS,
    "payments": PAYMENTS,
    "items": ITEMS,
    "reviews": REVIEWS,
    "products": PRODUCTS,
}

# Landed feeds --------------------------------------------------------------
INDICATOR = struct(data=STRING, valor=STRING)
INDICATOR_DOC = T.ArrayType(INDICATOR)
WEATHER_DOC = struct(
    main=struct(temp=DOUBLE, humidity=INT, pressure=INT),
    weather=T.ArrayType(struct(description=STRING)),
    wind=struct(speed=DOUBLE),
)

# Sales events ----------------------------------------------------------------
SALES_EVENT = struct(timestamp=STRING, customer_state=STRING, price=STRING, order_id=STRING, event_sequence_id=LONG)
SALES_REQUIRED = ["customer_state", "price", "order_id", "timestamp"]

# Governance -----------------------------------------------------------------
AUDIT = struct(
    timestamp=NTZ, level=STRING, dag_id=STRING, task_id=STRING, user=STRING, action=STRING, details=STRING,
    compliance_status=STRING, risk_level=STRING, service=STRING, error_message=STRING,
    stack_trace_needed=T.BooleanType(),
)
AUDIT_COLUMNS = AUDIT.fieldNames()
KEY_HISTORY = struct(version=STRING, key_value=T.BinaryType(), created_at=NTZ, expires_at=NTZ)
