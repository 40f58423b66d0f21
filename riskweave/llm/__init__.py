"""Operators for training data at scale: tokens, duplicates, packing, language, extraction, search, toxicity, personal data."""

from __future__ import annotations


def all_queries() -> dict:
    from riskweave.llm import (align, exact, jaccard, language, lexical, packing, pages, pieces, suffixes, surrogates, topk,
                               toxicity, warc)

    return {
        "op1_sentencepiece": pieces.op1_sentencepiece,
        "op2_exact_dedup": exact.op2_exact_dedup,
        "op3_best_fit_packing": packing.op3_best_fit_packing,
        "op4_suffix_dedup": suffixes.op4_suffix_dedup,
        "op5_ngram_jaccard_join": jaccard.op5_ngram_jaccard_join,
        "op6_language_id": language.op6_language_id,
        "op7_html_extraction": pages.op7_html_extraction,
        "op8_exact_topk": topk.op8_exact_topk,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_pii_surrogates": surrogates.op10_pii_surrogates,
        "op11_tokenizer_alignment": align.op11_tokenizer_alignment,
        "op12_lexical_search": lexical.op12_lexical_search,
        "op13_warc": warc.op13_warc,
    }


def all_oracles() -> dict[str, str]:
    from riskweave.llm import exact, jaccard, lexical, topk, warc

    return {"op2_exact_dedup": exact.OP2_SQL, "op5_ngram_jaccard_join": jaccard.OP5_SQL,
            "op8_exact_topk": topk.OP8_SQL, "op12_lexical_search": lexical.OP12_SQL, "op13_warc": warc.OP13_SQL}
