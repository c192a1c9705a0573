"""Writers: sized CSV, per-batch CSV, date-partitioned output."""
