"""Config-driven loading of client data files into staging tables, on Spark."""
