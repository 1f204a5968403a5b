"""Column-expression helpers: reference-date windows, masks and safe arithmetic."""
