"""Where change rows, tables and bookmarks come from."""
