"""Column expressions: tokenising, dates, links, markup."""
