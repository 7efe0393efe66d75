"""Training-data operators: decontamination, near-duplicates, filters, PII, packing and scoring."""
