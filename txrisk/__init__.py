"""Risk analytics on change-data-capture streams, written as Spark DataFrame functions."""
