"""Column functions: they take and return columns and add no shuffle."""
