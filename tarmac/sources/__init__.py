"""Reading and writing: landed CSV files, layer tables, driver tables."""
