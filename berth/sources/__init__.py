"""Sources: the expected catalogue, file listings, CSV readers and the
landing-zone frames derived from the driver tables."""
