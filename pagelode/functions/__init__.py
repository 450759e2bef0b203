"""Column expressions: text analysis, stemming, scoring, markup, presentation."""
