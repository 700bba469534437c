"""Where rows come from: event streams, stored tables, JDBC and the given Parquet tables."""
