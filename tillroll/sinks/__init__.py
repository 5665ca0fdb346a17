"""Writers: marts, partitioned and versioned marts, JDBC, quarantine, ledger."""
