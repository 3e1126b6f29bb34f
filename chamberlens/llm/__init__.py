"""Training-data operators: cleaning, matching, tokenising and searching large text tables."""
