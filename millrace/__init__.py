"""millrace: a PySpark-native engine for a job-market inventory and for text corpora."""
