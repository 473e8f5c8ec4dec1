"""Plans over the driver's tables: collections, queries and the SQL they are checked with."""
