"""DataFrame -> DataFrame operators; apply with ``df.transform(op, ...)``."""
