"""Where data comes from and goes to: tables, files, parsers, the shared work folder."""
