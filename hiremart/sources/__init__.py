"""Sources: landing-zone readers (paged JSON, dictionaries), enrichment, and the
mapping of the driver's test tables onto the landing model."""
