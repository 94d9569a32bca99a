"""Values the reports and audits are defined by."""

# Securable types.
CATALOG = "Catalog"
SCHEMA = "Schema"
TABLE = "Table"
FUNCTION = "Function"

# Privilege labels.
ALL_PRIVILEGES = "ALL_PRIVILEGES"
NO_EXPLICIT_PERMISSIONS = "No Explicit Permissions"

# Fixed value: catalogs of this type are shared in from elsewhere and not scanned for tags.
SHARED_CATALOG_TYPE = "DELTASHARING_CATALOG"

# Verdicts and states of the routine audit.
VALID_FUNCTION = "validFunction"
INVALID_FUNCTION = "invalidFunction"
VALID_SECRET = "validSecret"
INVALID_SECRET = "invalidSecret"
NOT_AUDITED = "notAudited"
REMOVE = "remove"

# Function names a routine must not call, and the keys it may use by scope.
BANNED_FUNCTIONS = ("hash", "mask", "md5", "sha", "sha1", "sha2", "crc32")
ALLOWED_KEYS = {
    "scope1": ("key1",),
    "scope2": ("key2",),
    "scope3": ("key3",),
    "encryptionkeys": ("ssn",),
}

# What ALL_PRIVILEGES stands for on each securable type.
INHERITED_PRIVILEGES = {
    CATALOG: (
        "USE CATALOG",
        "USE SCHEMA",
        "SELECT",
        "MODIFY",
        "EXECUTE",
        "READ VOLUME",
        "WRITE VOLUME",
        "CREATE SCHEMA",
        "CREATE TABLE",
        "CREATE FUNCTION",
        "CREATE VOLUME",
    ),
    SCHEMA: (
        "USE SCHEMA",
        "SELECT",
        "MODIFY",
        "EXECUTE",
        "READ VOLUME",
        "WRITE VOLUME",
        "CREATE TABLE",
        "CREATE FUNCTION",
        "CREATE VOLUME",
    ),
    TABLE: ("SELECT", "MODIFY"),
    FUNCTION: ("EXECUTE",),
}
