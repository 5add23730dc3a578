"""DataFrame operators for omics evidence: enrichment, dataset discovery and sequence evidence."""
