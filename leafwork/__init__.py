"""Document-corpus analytics on Spark: page assembly, headings, chunk planning, geometry and corpus bookkeeping."""
