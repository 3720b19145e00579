"""footfall: web-log and order analytics written as plain PySpark jobs."""
