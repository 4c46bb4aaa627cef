"""Reading and writing: files, tables, JDBC, and the shared staging folder."""
