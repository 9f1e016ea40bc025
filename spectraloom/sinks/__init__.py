"""Writers of reports, tables and files."""
