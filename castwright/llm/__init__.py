"""Training-data operators: near-duplicates, filters, classifiers, scans, decontamination, BPE."""
