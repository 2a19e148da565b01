"""Training-data operators: dedup, quality, decontamination, PII, secrets, packing, chat formatting."""
