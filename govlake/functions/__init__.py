"""Column-to-column helpers: masks, normalisation, generalisation."""
