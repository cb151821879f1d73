"""Operators for building training data from text: near duplicates, decontamination, classifiers, packing, archives."""
