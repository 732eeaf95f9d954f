"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from revlens.llm import (bpe, chat_format, decontaminate, exact_dedup, hard_negatives, language_id, packing, quality,
                         simhash, substring_dedup, token_files, warc, whitening)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_exact_dedup": exact_dedup.op2_exact_dedup,
    "op3_simhash": simhash.op3_simhash,
    "op4_decontaminate": decontaminate.op4_decontaminate,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_bpe": bpe.op6_bpe,
    "op7_quality": quality.op7_quality,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_token_files": token_files.op9_token_files,
    "op10_warc": warc.op10_warc,
    "op11_whitening": whitening.op11_whitening,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_packing": packing.op13_packing,
}

SQL = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op4_decontaminate": decontaminate.ORACLE,
    "op5_chat_format": chat_format.ORACLE,
    "op10_warc": warc.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
