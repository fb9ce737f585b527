"""Writers: idempotent batch appends, reports, and file deposits run by executors."""
