"""Writers: tables, exchange text, JSON lines, metrics and SQL folders."""
