"""Training-data operators: copies, near copies, languages, personal data, licences, toxicity, tokens, mixtures, search."""
