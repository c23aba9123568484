"""Training-data operators: URL filters, WARC, near-duplicates, decontamination, toxicity, mixing, token files.

Nothing else in the library imports this subpackage; general helpers of the library may be imported here.
"""
