"""Writers: document files, corpus files, show tables and releases."""
