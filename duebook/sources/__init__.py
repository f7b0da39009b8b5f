from duebook.sources.tables import load, read_table
