"""Queries of this subpackage, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from quartermaster.llm import (lattice, licenses, lines, mixing, packing, periods, pieces, quality, secrets, simhash,
                               spelling, suffix_dedup, winnowing)

#: query name -> function of (spark, sf_dir)
QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_license_scan": licenses.op2_license_scan,
    "op3_secret_scan": secrets.op3_secret_scan,
    "op4_mixing": mixing.op4_mixing,
    "op5_fingerprints": winnowing.op5_fingerprints,
    "op6_simhash_near_dedup": simhash.op6_simhash_near_dedup,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_sentencepiece": pieces.op8_sentencepiece,
    "op9_line_dedup": lines.op9_line_dedup,
    "op10_embedding_near_dedup": lattice.op10_embedding_near_dedup,
    "op11_packing": packing.op11_packing,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_periodic_runs": periods.op13_periodic_runs,
}

#: query name -> DuckDB SQL, where SQL can express it on whole tables
ORACLE: dict[str, str] = {
    "op4_mixing": mixing.ORACLE,
    "op7_suffix_dedup": suffix_dedup.ORACLE,
    "op9_line_dedup": lines.ORACLE,
}
