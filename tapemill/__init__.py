"""Market-data lakehouse operators expressed as Spark DataFrame plans."""
