"""chainlattice: a Spark-first label and entity-resolution engine for on-chain addresses."""
