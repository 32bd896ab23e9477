"""DataFrame operators, one module per stage of curation."""
