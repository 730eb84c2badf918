"""Sources (readers, ERP extracts, test-table stand-ins) and sinks."""
