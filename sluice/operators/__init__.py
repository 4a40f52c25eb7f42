"""DataFrame-to-DataFrame operators: filters, rules, merge, quality checks and reports."""
