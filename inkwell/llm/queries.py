"""The queries of this subpackage, for the driver's entry module."""

from __future__ import annotations

import corpus_pipeline
from inkwell.llm import bpe, exact, idfiles, langid, licenses, manifest, mixing, ngrams, quality, ranked, rules, secrets, urlfilter

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_language_id": langid.op2_language_id,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_bpe_round_trip": bpe.op5_bpe_round_trip,
    "op6_quality_rules": rules.op6_quality_rules,
    "op7_token_id_files": idfiles.op7_token_id_files,
    "op8_ngram_jaccard_join": ngrams.op8_ngram_jaccard_join,
    "op9_quality_score": quality.op9_quality_score,
    "op10_exact_dedup": exact.op10_exact_dedup,
    "op11_ranked_search": ranked.op11_ranked_search,
    "op12_merkle_manifest": manifest.op12_merkle_manifest,
    "op13_url_filter": urlfilter.op13_url_filter,
    "pipeline": corpus_pipeline.run,
}
ORACLES = {
    "op3_mix_sources": mixing.OP3_SQL,
    "op6_quality_rules": rules.OP6_SQL,
    "op8_ngram_jaccard_join": ngrams.OP8_SQL,
    "op10_exact_dedup": exact.OP10_SQL,
    "op11_ranked_search": ranked.OP11_SQL,
    "op12_merkle_manifest": manifest.OP12_SQL,
}
