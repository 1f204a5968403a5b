"""Role sources: declared schemas, file readers and the driver-table mapping."""
