"""Plans of the curation engine."""
