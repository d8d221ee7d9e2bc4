"""Training-data operators: mixing, fingerprints, language, decontamination, near-duplicates,
licences, toxicity, page text, token counts and quality.  Nothing outside this folder imports it."""
