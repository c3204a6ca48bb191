"""lakemart: reusable lakehouse operators written as plain PySpark DataFrame functions."""
