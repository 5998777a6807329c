"""The queries of this subpackage and their SQL twins."""

from annolake.llm import (
    alignment,
    collocations,
    decontaminate,
    importance,
    mixing,
    packing,
    sharding,
    simhash,
    substring,
    suffixes,
    tokenbin,
    versions,
    warc,
)

_MODULES = [
    warc, sharding, importance, simhash, substring, suffixes, decontaminate, tokenbin, versions, mixing, collocations, packing, alignment,
]
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
