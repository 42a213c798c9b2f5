"""Training-data operators: packing, page differencing, near-dedup, WARC, shards, BPE, top-k, toxicity, quality, licences.

Nothing outside this subpackage imports it, and it imports nothing from the rest of the library.
"""
