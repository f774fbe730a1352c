"""loamline: corpus curation as lazy Spark plans."""
