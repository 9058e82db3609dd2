"""DataFrame -> DataFrame operators: pages, lexicon, similarity, classification, curation, report."""
