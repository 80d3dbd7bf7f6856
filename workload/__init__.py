"""Every operator and query of the library, over the star-schema test tables."""
