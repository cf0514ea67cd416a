"""Column expressions: text, JSON, languages, links, scores, messages and error texts."""
