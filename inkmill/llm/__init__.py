"""Operators of a training-data pipeline; nothing outside this folder imports it but the entry module, which can do without."""

from __future__ import annotations

from . import clicks, exact_dedup, language, lexical, main_text, mixing, ordinal, packing, quality_rules, simhash, substring_dedup, suffix_array, token_output


def queries() -> dict:
    """Query name -> callable of (spark, sf_dir)."""
    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_language": language.op2_language,
        "op3_quality_rules": quality_rules.op3_quality_rules,
        "op4_token_output": token_output.op4_token_output,
        "op5_suffix_array": suffix_array.op5_suffix_array,
        "op6_substring_dedup": substring_dedup.op6_substring_dedup,
        "op7_mixing": mixing.op7_mixing,
        "op8_packing": packing.op8_packing,
        "op9_exact_dedup": exact_dedup.op9_exact_dedup,
        "op10_ordinal": ordinal.op10_ordinal,
        "op11_main_text": main_text.op11_main_text,
        "op12_clicks": clicks.op12_clicks,
        "op13_lexical": lexical.op13_lexical,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {
        "op3_quality_rules": quality_rules.OP3_SQL,
        "op5_suffix_array": suffix_array.OP5_SQL,
        "op6_substring_dedup": substring_dedup.OP6_SQL,
        "op7_mixing": mixing.OP7_SQL,
        "op9_exact_dedup": exact_dedup.OP9_SQL,
        "op13_lexical": lexical.OP13_SQL,
    }
