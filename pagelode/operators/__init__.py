"""DataFrame-to-DataFrame steps: ids, links, ranks, frontier, robots, postings, joins."""
