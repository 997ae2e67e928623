"""Multi-step work: publishing tables, the medallion build, the state suite, the query registry."""
