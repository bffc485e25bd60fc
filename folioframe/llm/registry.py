"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from folioframe.llm import flac, linedup, mixing, pieces, pii, quality, simhash, substrings, toxicity, warc


def queries():
    return {
        "op1_substrings": substrings.query,
        "op2_mixing": mixing.query,
        "op3_simhash": simhash.query,
        "op4_linedup": linedup.query,
        "op5_warc": warc.query,
        "op6_pieces": pieces.query,
        "op7_flac": flac.query,
        "op8_pii": pii.query,
        "op9_toxicity": toxicity.query,
        "op10_quality": quality.query,
    }


def oracle_sql():
    return {"op2_mixing": mixing.SQL}
