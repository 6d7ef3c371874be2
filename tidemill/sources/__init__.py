"""What the jobs read: CSV drops, files as units, periods, tables by name."""
