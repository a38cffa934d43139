"""Queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from heatledger.llm import decontam, langid, licenses, linededup, ngrams, packing, phrases, quality, simhash, substrings, urlfilter, warc, whitening

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "language_id_pages": langid.language_id_pages,
    "op2_warc": warc.op2_warc,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_decontamination": decontam.op4_decontamination,
    "op5_lm_scoring": ngrams.op5_lm_scoring,
    "op6_quality": quality.op6_quality,
    "op7_packing": packing.op7_packing,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_simhash": simhash.op10_simhash,
    "op11_collocations": phrases.op11_collocations,
    "op12_whitening": whitening.op12_whitening,
    "op13_url_filter": urlfilter.op13_url_filter,
}
ORACLES = {"op9_line_dedup": linededup.ORACLE, "op11_collocations": phrases.ORACLE}
