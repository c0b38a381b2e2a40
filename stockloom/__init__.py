"""Batch analytics on listed companies, written as Spark DataFrame plans."""
