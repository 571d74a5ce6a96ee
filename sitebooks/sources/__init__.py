"""Reading and writing: file feeds, delimited text, catalog tables, warehouse."""
