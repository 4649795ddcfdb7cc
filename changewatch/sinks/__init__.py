"""Writers for reports."""
