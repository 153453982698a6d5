"""Training-data operators: dedup, packing, language, privacy, safety, quality, decontamination, token files, search.

Nothing outside this subpackage imports it; ``registry`` lists its queries.
"""
