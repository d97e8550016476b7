"""Queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from estatelake.llm import langid, line_dedup, mixing, near_dedup, packing, periodic_runs, quality, secret_scan, simhash, spelling, substring_dedup, topk, warc


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op10_mix_sources": mixing.op10_mix_sources,
        "op3_best_fit_packing": packing.op3_best_fit_packing,
        "op2_language_id": langid.op2_language_id,
        "op4_secret_scan": secret_scan.op4_secret_scan,
        "op6_quality_rules": quality.op6_quality_rules,
        "op5_near_dedup": near_dedup.op5_near_dedup,
        "op7_exact_top_k": topk.op7_exact_top_k,
        "op8_warc": warc.op8_warc,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op11_simhash": simhash.op11_simhash,
        "op12_spelling_variants": spelling.op12_spelling_variants,
        "op13_periodic_runs": periodic_runs.op13_periodic_runs,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": line_dedup.ORACLE, "op10_mix_sources": mixing.ORACLE, "op6_quality_rules": quality.ORACLE, "op7_exact_top_k": topk.ORACLE}
