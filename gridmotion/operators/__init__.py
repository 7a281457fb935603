"""DataFrame -> DataFrame operators with configurable column names."""
