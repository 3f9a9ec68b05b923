"""The registered queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from . import exact_dedup, language, licenses, mixing, packing, phrases, repeats, runs, sharding, simhash, token_counts, topk, warc


def queries() -> dict:
    return {
        "op1_suffix_array_dedup": repeats.op1_suffix_array_dedup,
        "op2_warc_capture_index": warc.op2_warc_capture_index,
        "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
        "op4_pack_best_fit": packing.op4_pack_best_fit,
        "op5_language_id": language.op5_language_id,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_license_scan": licenses.op7_license_scan,
        "op8_curriculum_mix": mixing.op8_curriculum_mix,
        "op9_byte_shards": sharding.op9_byte_shards,
        "op10_bit_sliced_topk": topk.op10_bit_sliced_topk,
        "op11_token_counts": token_counts.op11_token_counts,
        "op12_periodic_runs": runs.op12_periodic_runs,
        "op13_collocations": phrases.op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_warc_capture_index": warc.ORACLE,
        "op6_exact_dedup": exact_dedup.ORACLE,
        "op8_curriculum_mix": mixing.ORACLE,
        "op10_bit_sliced_topk": topk.ORACLE,
        "op13_collocations": phrases.ORACLE,
    }
