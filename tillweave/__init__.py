"""tillweave: loyalty-spend analytics expressed as PySpark DataFrame plans."""
