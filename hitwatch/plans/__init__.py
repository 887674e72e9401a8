"""Named queries over a folder of tables, and their SQL twins."""
