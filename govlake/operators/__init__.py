"""DataFrame operators: typing, quality, policies, access, lineage, anonymity."""
