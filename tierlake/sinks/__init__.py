"""Tables, views and the load log."""
