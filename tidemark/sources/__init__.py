"""Everything that reads or writes storage: driver tables, landing JSON, versioned commits."""
