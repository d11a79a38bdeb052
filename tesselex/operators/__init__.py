"""DataFrame operators: acts, pages, chunks, search and evaluation."""
