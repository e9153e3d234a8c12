"""Medallion analytics on Spark: raw trips to checked, published marts."""
