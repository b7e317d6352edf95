"""Sources: databases over JDBC, and the lake's files."""
