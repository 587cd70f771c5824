"""Names, thresholds and texts that results depend on."""

# --- transactions -----------------------------------------------------------
CAMEL_BOUNDARY = "(?<=[a-z])(?=[A-Z])"  # where a name gets an underscore
CANCELLATION_PREFIX = "C"
MISSING_INVOICE_TEXT = "nan"  # a null invoice number still counts as one invoice
DEFAULT_SHOPPING_HOUR = 12
SHORT_WINDOW_DAYS = 30
LONG_WINDOW_DAYS = 90

RFM_COLUMNS = [
    "customer_id",
    "recency",
    "frequency",
    "avg_order_value",
    "spending_velocity",
    "cancellation_rate",
    "preferred_shopping_hour",
]
SEGMENTATION_FEATURES = ["recency", "frequency", "avg_order_value"]
CHURN_FEATURES = RFM_COLUMNS[1:]
LOG_SCALED_FEATURES = ["frequency", "avg_order_value"]

# --- segments ---------------------------------------------------------------
INACTIVE = "Inactive Customers"
FREQUENT = "Frequent Buyers"
HIGH_VALUE = "Occasional High Value Buyers"
MEDIUM = "Medium Customers"
UNKNOWN_SEGMENT = "Unknown"
INACTIVE_RECENCY_OVER = 150
FREQUENT_OVER = 10
HIGH_VALUE_OVER = 500
DEFAULT_CLUSTER_LABELS = {0: INACTIVE, 1: MEDIUM, 2: FREQUENT, 3: HIGH_VALUE}

# --- churn ------------------------------------------------------------------
CUTOFF_DAYS = 90
TEST_FRACTION = 0.2
SPLIT_SEED = 42
FALLBACK_RECENCY_OVER = 90
FALLBACK_AT_RISK = (0.5, 1)
FALLBACK_LOYAL = (0.1, 0)

# --- catalogue and campaign -------------------------------------------------
CATALOGUE_SIZE = 1000
EMBED_BATCH = 100
TOP_K = 3
UNKNOWN_PRODUCT = "Unknown Product"

DEFAULT_PROFILE = {
    "recency": 30,
    "frequency": 5,
    "avg_order_value": 100.0,
    "spending_velocity": 1.0,
    "cancellation_rate": 0.0,
    "preferred_shopping_hour": 12,
    "segment": MEDIUM,
    "last_purchased": "RED RETROSPOT WRAP",
    "churn_probability": 0.15,
    "is_churn": 0,
}

DEFAULT_RECOMMENDATIONS = [
    ("85123A", "WHITE HANGING HEART T-LIGHT HOLDER", 2.55, 0.85),
    ("22423", "REGENCY CAKESTAND 3 TIER", 12.75, 0.72),
    ("47566", "PARTY BUNTING", 4.95, 0.68),
]

WINBACK_CODE = "WINBACK20"
SHIPPING_CODE = "SHIPSAFE"
LOYALTY_CODE = "LOYALTYVIP"
WINBACK_VELOCITY_UNDER = 0.8
APOLOGY_CANCELLATION_OVER = 0.15
WINBACK_OFFER = "20% off with code WINBACK20"
LOYALTY_OFFER = "early access with code LOYALTYVIP"
APOLOGY_TEXT = (
    "We noticed some of your recent orders were cancelled. We'd love to make things right "
    "and guarantee a smooth checkout next time!"
)

# {name} marks are filled in by the campaign operator, one piece of text per mark.
CAMPAIGN_TEXT = """# Subject: Special Offer: Inspired by your recent purchase!

Dear Customer {customer_id},

We hope you are having a wonderful day! {apology} We noticed you recently purchased the **"{last_purchased}"** and loved it. 

Based on your taste, we thought you might enjoy these top recommendations from our collection:
{recommendations}

Because you are a valued customer, we'd like to offer you a special benefit: **{offer}**!

Enter the code at checkout. We hope to see you again soon!

Best regards,  
*Your E-Commerce Marketing Team*

**Delivery Meta:** [Schedule Delivery for {hour}:00]
"""

# --- feed -------------------------------------------------------------------
BASELINE_CANCEL_RATE = 0.05
DRIFT_CANCEL_RATE = 0.40
