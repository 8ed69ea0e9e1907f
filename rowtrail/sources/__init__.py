"""Reading change feeds and writing history, status and registry tables."""
