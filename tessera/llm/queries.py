"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from tessera.llm import (decontaminate, jaccard_join, line_dedup, pii, projection_forest,
                         quality_classifier, quality_rules, sentencepiece_fst, spelling_variants, token_align, token_pack, url_lists,
                         warc)
from tessera.sources.tables import read_table

QUERIES = {
    "op1_warc_archive": lambda spark, sf_dir: warc.op1_warc_archive(read_table(spark, sf_dir, "pages")),
    "op2_token_pack": token_pack.op2_token_pack,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_url_lists": url_lists.op5_url_lists,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_personal_data": pii.op7_personal_data,
    "op8_jaccard_join": jaccard_join.op8_jaccard_join,
    "op9_sentencepiece": sentencepiece_fst.op9_sentencepiece,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_projection_forest": projection_forest.op11_projection_forest,
    "op12_spelling_variants": spelling_variants.op12_spelling_variants,
    "op13_token_align": token_align.op13_token_align,
}

#: The others are tested against brute force: no SQL tells their results.
ORACLE = {
    "op1_warc_archive": warc.ORACLE_SQL,
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op5_url_lists": url_lists.ORACLE_SQL,
}
