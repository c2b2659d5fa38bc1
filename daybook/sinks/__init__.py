"""Writers: date-partitioned lake tables, database tables, reports, step log."""
