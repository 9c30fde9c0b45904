"""Fixed values the results depend on.

These must equal those of the scheduled cost scripts for the marts to come
out the same; they are kept here, together and in the order the scripts use
them, and imported everywhere else.
"""

# --- fixed values -------------------------------------------------------------------
REGION = "asia-northeast1"          # region of the telemetry views and of the price rows
ZONE = "Asia/Tokyo"                 # zone of "today", of month boundaries and of local dates
EXCLUDED_RESERVATION = "default-pipeline"   # reservation id left out of edition costs
SCRIPT_STATEMENT = "SCRIPT"         # statement type left out of compute costs
FINISHED_STATE = "DONE"             # job state kept by query and slot analysis
RECENT_WINDOW_LAG_MINUTES = 5       # "until five minutes ago"
EDITION_CLASSES = {                 # edition -> compute price class; other editions have no price
    "STANDARD": "standard",
    "ENTERPRISE": "enterprise",
    "ENTERPRISE_PLUS": "enterprise_plus",
}
ON_DEMAND_CLASS = "on_demand"       # compute price class of on-demand bytes
STORAGE_PRICE_COLUMNS = {           # storage class -> price column
    "comp_active": "active_compressed_pricing",
    "comp_long_term": "long_term_compressed_pricing",
    "logic_active": "active_logical_pricing",
    "logic_long_term": "long_term_logical_pricing",
}
BILLING_MODEL_OPTION = "storage_billing_model"  # schema option naming the storage billing model
PHYSICAL_MODEL = "PHYSICAL"         # billing model counted as physical (compressed)
DEFAULT_MODEL = "LOGICAL"           # reported when a dataset has no billing model
ADMIN_PROJECT_PATTERN = "^.*:"      # reservation id up to its last colon ...
ADMIN_PROJECT_DROP = ":"            # ... with every colon removed
GIB = float(1024**3)                # storage unit
TIB = float(1024**4)                # on-demand and query-size unit
SLOT_ROUNDING = 100                 # slot seconds are rounded up to whole hundreds
HOURS_PER_DAY = 24                  # baseline cost charges the whole day
