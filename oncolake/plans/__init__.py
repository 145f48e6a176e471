"""Whole plans: from reports to tables, envelopes, bundles and quality results."""
