"""The lap mart: cleaning, assembly, reports and the batch pipeline."""
