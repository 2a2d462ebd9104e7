"""Jobs that publish tables and run a month end to end."""
