"""All queries and comparison SQL of this package."""

from refrain.llm import encoding, imatch, jaccard, language, lines, merkle, middle, mixing, pii, quality, secrets, token_files, urls

_MODULES = [encoding, jaccard, mixing, imatch, language, urls, token_files, secrets, pii, quality, middle, merkle, lines]
QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
