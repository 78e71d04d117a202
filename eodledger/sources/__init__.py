"""Reading and writing tables, CSV files, sharded sources and text corpora."""
