"""Plans: the pipeline's jobs, registered queries, and their oracles."""
