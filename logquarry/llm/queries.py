"""The registered queries of this subpackage and their SQL counterparts."""

from logquarry.llm import decontaminate, hamming, language, neardup, negatives, pack, pages, phrases, quality, shard, toxicity, urls, warc

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_url_filter": urls.op2_url_filter,
    "op3_near_duplicates": neardup.op3_near_duplicates,
    "op4_shard": shard.op4_shard,
    "op5_pack": pack.op5_pack,
    "op6_hamming_search": hamming.op6_hamming_search,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_quality": quality.op8_quality,
    "op9_warc": warc.op9_warc,
    "op10_language": language.op10_language,
    "op11_extract_text": pages.op11_extract_text,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_collocations": phrases.op13_collocations,
}
ORACLE_SQL = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op2_url_filter": urls.OP2_SQL,
    "op6_hamming_search": hamming.OP6_SQL,
    "op9_warc": warc.OP9_SQL,
    "op12_hard_negatives": negatives.OP12_SQL,
    "op13_collocations": phrases.OP13_SQL,
}
