"""Operations of a training-data pipeline (language ID, packing, URL filters,
fingerprints, near-dedup, token counts, sharding, quality rules, secret scans,
byte-level BPE).  Nothing else in the library imports this subpackage."""
