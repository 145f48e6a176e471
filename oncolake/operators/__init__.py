"""DataFrame operators: consolidation, report explosion, bundling, references, de-identification."""
