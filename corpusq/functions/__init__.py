"""See the package docstring of :mod:`corpusq`."""
