"""Functions of the curation engine."""
