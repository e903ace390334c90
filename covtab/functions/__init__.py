"""Column expressions of the coverage data model: ``chrom`` and ``intervals``."""
