"""Sources: delimited text, JSON payloads, workbooks, cell grids, manifests,
request grids and fetch logs, JDBC tables."""
