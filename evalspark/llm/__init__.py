"""Training-data operators: language ID, PII, packing, fingerprints, quality,
decontamination, duplicate removal, similarity joins, licences, LM scoring,
collocations, near duplicates, source divergences.

Nothing else in the library imports this subpackage.
"""
