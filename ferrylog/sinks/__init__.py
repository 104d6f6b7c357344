"""Writers: tables, export files, applied tables, ledgers and task messages."""
