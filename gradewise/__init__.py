"""gradewise: credit-portfolio risk analytics as Spark DataFrame jobs."""
