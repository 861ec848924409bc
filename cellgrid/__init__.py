"""DataFrame operators for droplet single-cell data, and for training-data corpora (``cellgrid.llm``)."""
