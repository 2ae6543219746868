"""Reading and writing of tables and events."""
