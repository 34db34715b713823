"""Reading and writing: contracts, files, relational tables, document sets."""
