"""Set operators over landed pages, typed records and control tables."""
