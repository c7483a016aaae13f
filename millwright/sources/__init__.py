"""Where tables and models are read from and written to."""
