"""They must equal the published behaviour for results to match."""

# Tokens a CSV reader with default NA handling turns into NULL.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Masking.
STATIC_MASK = "[DADO_MASCARADO]"
CITY_MASK = "[CIDADE_REMOVIDA_LGPD]"

# Columns read from each table by the order-first consolidation.
ORDER_FIRST_COLUMNS = {
    "customers": ["customer_id", "customer_city", "customer_state"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "payments": ["order_id", "payment_type", "payment_value"],
    "items": ["order_id", "product_id", "price", "freight_value"],
    "reviews": ["order_id", "review_score"],
    "products": ["product_id", "product_category_name"],
}

# Data quality.
ORDER_STATUSES = [
    "delivered", "shipped", "canceled", "invoiced", "processing", "approved", "unavailable", "created",
]
SUCCESS_RATE_FLOOR = 0.95
NULL_TOLERANCE = 0.01
TEMPERATURE_RANGE = (-10, 50)

# Sales stream.
MIN_PRICE = 100
UNKNOWN_STATE = "UNKNOWN"

# Star schema.
FACT_REQUIRED = ["order_id", "customer_id", "product_id", "price", "order_purchase_timestamp"]
JDBC_BATCH_ROWS = 10_000

# Audit.
AUTHORITY_DROPPED = ["user", "risk_level", "error_message", "stack_trace_needed", "service"]
BREACH_SEVERITIES = ["CRITICAL", "URGENT", "HIGH"]
AUDIT_DEFAULTS = {
    "dag_id": "system",
    "task_id": "system",
    "user": "airflow_process",
    "action": "GENERIC_EVENT",
    "compliance_status": "LGPD_NA",
    "service": "N/A",
    "error_message": "",
}
# level -> (default action, default compliance, default risk; None = the level itself)
AUDIT_PRESETS = {
    "INFO": ("INFO_EVENT", "LGPD_OK", None),
    "WARNING": ("WARNING_EVENT", "LGPD_WARNING", "MEDIUM"),
    "ERROR": ("ERROR_EVENT", "LGPD_BREACH", "HIGH"),
}
# masking method -> (action, compliance status) of its audit row
MASK_AUDIT = {
    "hash": ("DATA_MASKED_HASH", "LGPD_PSEUDONYMIZED"),
    "fake": ("DATA_MASKED_FAKE", "LGPD_PSEUDONYMIZED"),
    "static": ("DATA_MASKED_STATIC", "LGPD_ANONYMIZED"),
    "partial": ("DATA_MASKED_PARTIAL", "LGPD_PSEUDONYMIZED"),
}
# Texts of audit rows, as readers of the audit table know them.
OPERATION_TEXT = "Operação: "
METADATA_TEXT = " | Metadados: "
INCIDENT_TEXT = "INCIDENTE DETECTADO: "
UPLOAD_TEXT = "Arquivo enviado de '%s' para '%s'."
TRANSFER_TEXT = "Objeto '%s' transferido de '%s' para '%s'."
INVALID_PRICE_TEXT = "Evento com 'price' invalido: %s. Pulando processamento."
PROCESSED_TEXT = "State: %s, Value: R$ %s"
SKIPPED_TEXT = "Evento de venda ignorado (preco <= R$ %s): R$ %s"
UPLOAD_SERVICE = "MinIO/S3"
TRANSFER_SERVICE = "MinIO/S3_Lifecycle"
VALIDATION_SERVICE = "Data_Validation"
INCIDENT_SERVICE = "SECURITY_SYSTEM"
INCIDENT_USER = "security_system"

# Lifecycle and keys.
HOT_DAYS = 30
KEY_LIFETIME_DAYS = 90
