"""Training-data operators: near-duplicates, quality, personal data, secrets,
licences, tokenising and packing. Nothing outside this subpackage imports it."""
