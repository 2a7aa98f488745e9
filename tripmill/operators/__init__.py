"""Row- and table-level operators on trip DataFrames."""
