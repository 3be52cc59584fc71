"""Ready-made reports, and the catalogue that runs everything over the benchmark tables."""
