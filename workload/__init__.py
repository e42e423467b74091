"""The operators on the driver tables: inputs, queries and the SQL they are checked with."""
