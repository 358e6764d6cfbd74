"""Reading and writing: tables, lookup files, databases, intermediate results."""
