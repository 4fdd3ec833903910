"""Writers: raw landing, table commits, CSV exports."""
