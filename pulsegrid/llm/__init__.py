"""Training-data operators: language, mixing, near copies, packing, search, secrets, sharding, toxicity."""
