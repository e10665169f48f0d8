"""The registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from landgrid.llm.fingerprint import op10_fingerprint
from landgrid.llm.html_extract import op1_html_extract
from landgrid.llm import licenses, ngram_join, outliers, quotations
from landgrid.llm.licenses import op3_licenses
from landgrid.llm.mixing import op2_mixing
from landgrid.llm.ngram_join import op8_ngram_join
from landgrid.llm.outliers import op4_outliers
from landgrid.llm.packing import op7_packing
from landgrid.llm.quality import op5_quality
from landgrid.llm.quotations import op9_quotations
from landgrid.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_html_extract": op1_html_extract,
    "op2_mixing": op2_mixing,
    "op3_licenses": op3_licenses,
    "op4_outliers": op4_outliers,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_packing": op7_packing,
    "op8_ngram_join": op8_ngram_join,
    "op9_quotations": op9_quotations,
    "op10_fingerprint": op10_fingerprint,
    # What else operators give beside their digests.
    "quality_counts": outliers.quality_counts,
    "chat_threads": quotations.chat_threads,
}

ORACLES: dict[str, str] = {
    "op3_licenses": licenses.oracle(),
    "op8_ngram_join": ngram_join.ORACLE,
    "op9_quotations": quotations.ORACLE,
    "quality_counts": outliers.COUNTS_ORACLE,
}
