"""DataFrame-to-DataFrame operators. None of them acts or collects."""
