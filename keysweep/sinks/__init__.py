"""Writers of the target, the catalog and the audit table."""
