"""Reading and writing article tables, feature tables and result tables."""
