"""Operators for building training corpora: personal data, toxicity, mixing,
near duplicates, decontamination, token counts, language models, quality and
language. Nothing outside this package imports it."""
