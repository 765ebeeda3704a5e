"""Reading and writing of landed files, tables, analysis frames and reference data."""
