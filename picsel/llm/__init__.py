"""Training-data operators: filtering, near-duplicate removal, decontamination, sharding, tokenization, model-based scores."""
