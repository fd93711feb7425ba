"""Sources and sinks: numbered text lines, graph text parsers, Parquet graph store, exports,
generators and the fixture graphs derived from the driver's tables."""
