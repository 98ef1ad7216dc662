"""DataFrame -> DataFrame operators. Each takes column names, so it runs on any table."""
