"""Training-data operators: near-dedup, mixing, surrogates, quality, line and
substring dedup, toxicity, language ID and BPE.  Nothing else in the library
imports this subpackage."""
