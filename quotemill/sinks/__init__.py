"""Writers of partitioned and flat tables."""
