"""Sources of the curation engine."""
