"""Publishing of tables, documents and text files."""
