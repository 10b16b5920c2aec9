"""Training-data operators: decontamination, quality, language models, BPE, dedup, WARC,
sharding and secret scans.  Nothing outside this package imports it."""
