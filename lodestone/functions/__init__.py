"""Column functions: URL keys, study levels, names, grades, money, dates, nested metadata and markdown."""
