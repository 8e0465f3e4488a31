"""Order, customer and product analytics as Spark DataFrame plans."""
