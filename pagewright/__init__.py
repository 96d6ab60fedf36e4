"""Document-evidence analytics on PySpark: flat evidence tables in, review-ready records out."""
