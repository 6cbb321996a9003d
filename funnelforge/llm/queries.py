"""The registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

from .shared import long_rows

_WHERE = {
    "op1_substring_dedup": "substring_dedup",
    "op2_minhash_near_dedup": "setsketch_dedup",
    "op3_sentencepiece": "sentencepiece_unigram",
    "op4_token_counts": "token_counts",
    "op5_warc": "warc",
    "op6_decontamination": "decontamination",
    "op7_line_dedup": "line_dedup",
    "op8_toxicity": "toxicity",
    "op9_embedding_near_dedup": "embedding_dedup",
    "op10_pii": "pii",
    "op11_embedding_whitening": "whitening",
    "op12_license_scans": "license_scan",
    "op13_phrase_collocations": "collocations",
}
_SQL = ("op1_substring_dedup", "op2_minhash_near_dedup", "op5_warc", "op7_line_dedup", "op9_embedding_near_dedup",
        "op12_license_scans", "op13_phrase_collocations")


def _module(name: str):
    return import_module(f"{__package__}.{_WHERE[name]}")


def registry() -> dict:
    def query(fn):
        def run(spark, sf_dir):
            long_rows(spark)
            return fn(spark, sf_dir)
        return run

    return {name: query(getattr(_module(name), name)) for name in _WHERE}


def oracle_sql() -> dict:
    return {name: getattr(_module(name), f"{name.split('_')[0].upper()}_SQL") for name in _SQL}
