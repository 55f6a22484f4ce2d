"""The stages of a whole analysis, from a dump to trained classifiers."""
