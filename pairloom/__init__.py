"""pairloom: curation of instruction/response pairs as Spark DataFrame jobs."""
