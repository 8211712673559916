"""Spark jobs for daily price snapshots, product catalogs and collections."""
