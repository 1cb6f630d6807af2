"""Training-data operators: dedup, packing, token output, mixing, scans,
classifiers and nearest neighbours, each built by one named method.

Nothing else in the package imports this one."""
