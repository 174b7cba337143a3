"""The queries of this subpackage and their DuckDB twins, by registered name."""

import corpus_pipeline
from admesh.llm import (
    chat, decontaminate, hosts, hyperminhash, licenses, likelihood, middle, pieces, pii, quality, spelling, suffixes,
    syncmers,
)


def queries() -> dict:
    return {
        "op1_decontaminate": decontaminate.op1_decontaminate,
        "op2_sentencepiece": pieces.op2_sentencepiece,
        "op3_suffix_dedup": suffixes.op3_suffix_dedup,
        "op4_syncmers": syncmers.op4_syncmers,
        "op5_host_reputation": hosts.op5_host_reputation,
        "op6_hyperminhash": hyperminhash.op6_hyperminhash,
        "op7_quality": quality.op7_quality,
        "op8_pseudo_likelihood": likelihood.op8_pseudo_likelihood,
        "op9_pii": pii.op9_pii,
        "op10_chat_windows": chat.op10_chat_windows,
        "op11_fill_in_middle": middle.op11_fill_in_middle,
        "op12_license_scan": licenses.op12_license_scan,
        "op13_spelling_variants": spelling.op13_spelling_variants,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_host_reputation": hosts.ORACLE,
        "op11_fill_in_middle": middle.ORACLE,
    }
