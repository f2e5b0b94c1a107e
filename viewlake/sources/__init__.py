"""Landing files, manifests, reports, versioned tables and the run ledger."""
