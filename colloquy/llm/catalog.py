"""Queries of this subpackage and their DuckDB SQL."""

from colloquy.llm import bagminhash, crf, doubling, html, mixing, ogg, orderhash, parsing, pieces, pii

QUERIES: dict = {
    "op1_sentencepiece": pieces.query,
    "op2_bagminhash": bagminhash.query,
    "op3_doubling": doubling.query,
    "op4_order_minhash": orderhash.query,
    "op5_pseudonyms": pii.query,
    "op6_ogg": ogg.query,
    "op7_prefix_free": parsing.query,
    "op8_html_text": html.query,
    "op9_pareto_mix": mixing.query,
    "op10_line_crf": crf.query,
}
ORACLES: dict[str, str] = {"op3_doubling": doubling.SQL, "op9_pareto_mix": mixing.SQL}
