"""Fixed values. Results depend on them, so they are stated once, here, as they are."""

# Kinds that are listed but never exported.
UNSUPPORTED_KINDS = ("STREAMING TABLE",)

# Catalog names that stand for each other and hold no streaming tables.
HIVE_CATALOGS = ("hive_metastore", "spark_catalog")

# Catalogs that exist without a governed metastore.
UNGOVERNED_CATALOGS = ("spark_catalog", "samples", "hive_metastore")

# Texts that mark an error as worth a retry.
TRANSIENT_MARKERS = (
    "REQUEST_LIMIT_EXCEEDED", "TOO_MANY_REQUESTS", "Too Many Requests", "429", "TEMPORARILY_UNAVAILABLE",
    "SERVICE_UNAVAILABLE", "503", "RESOURCE_EXHAUSTED", "StatusCode.UNAVAILABLE",
)

# Texts that mark an error as missing read access.
PERMISSION_MARKERS = ("PERMISSION_DENIED", "INSUFFICIENT_PERMISSIONS", "UnauthorizedAccessException")

# Retry policy.
RETRIES = 4
MAX_DELAY_SECONDS = 16
JITTER = (0.75, 1.25)

# Size limits of one submission.
MB = 1024 * 1024
WIRE_LIMIT_BYTES = 15 * MB
RAW_LIMIT_BYTES = 100 * MB

# Report sizes.
PAGE_SIZES = (100, 250, 500)
DEFAULT_PAGE_SIZE = 250
PREVIEW_OBJECTS = 200
FAILURE_GROUPS = 8
EXAMPLES_PER_GROUP = 3
REASON_CHARS = 600
SKIPPED_SCHEMAS = 25
SKIPPED_REASON_CHARS = 120
NAMED_SCHEMAS = 5
ETA_SHOWN_ABOVE_SECONDS = 90
