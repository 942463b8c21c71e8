"""Query name -> function, and query name -> DuckDB SQL."""

from colloquy.plans import answers, collate, evaluate, merges, records, speech, texts

QUERIES: dict = {**answers.QUERIES, **collate.QUERIES, **evaluate.QUERIES, **merges.QUERIES, **records.QUERIES, **speech.QUERIES, **texts.QUERIES}
ORACLES: dict[str, str] = {**answers.ORACLES, **collate.ORACLES, **evaluate.ORACLES, **merges.ORACLES, **records.ORACLES, **speech.ORACLES, **texts.ORACLES}
