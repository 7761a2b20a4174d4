"""Options, dialects, relations, table discovery and the SQL data source."""
