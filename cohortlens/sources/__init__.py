"""Reading and writing: the table contract, raw files, the star schema, reports."""
