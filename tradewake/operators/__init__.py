"""DataFrame -> DataFrame building blocks; no paths and no sessions in here, except where an
iterative fit first stores its input (see ``segments`` and ``regression``)."""
