"""Writers of ledgers, metric tables and result files."""
