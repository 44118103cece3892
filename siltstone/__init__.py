"""Bronze / Silver / Gold supply-chain analytics as Spark DataFrame plans."""
