"""DataFrame -> DataFrame steps, for use with ``df.transform(...)``."""
