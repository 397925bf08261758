"""Column functions: text, licenses, URLs, dates, markup."""
