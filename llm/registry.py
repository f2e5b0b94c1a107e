"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm import filter_audit, line_dedup, minhash_dedup, preferences, substring_dedup
from llm.decontamination import op8_decontamination
from llm.filter_audit import op13_filter_audit
from llm.fingerprints import op9_fingerprints
from llm.language_id import op10_language_id
from llm.line_dedup import op4_line_dedup
from llm.minhash_dedup import op5_minhash_dedup
from llm.mixing import op2_mix_sources
from llm.periodic_runs import op11_periodic_runs
from llm.preferences import op3_preference_format
from llm.pseudonyms import op6_pii_pseudonyms
from llm.sentence_pieces import op12_sentence_pieces
from llm.substring_dedup import op1_substring_dedup
from llm.token_output import op7_token_output

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_mix_sources,
        op3_preference_format,
        op4_line_dedup,
        op5_minhash_dedup,
        op6_pii_pseudonyms,
        op7_token_output,
        op8_decontamination,
        op9_fingerprints,
        op10_language_id,
        op11_periodic_runs,
        op12_sentence_pieces,
        op13_filter_audit,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": substring_dedup.SQL,
    "op3_preference_format": preferences.SQL,
    "op4_line_dedup": line_dedup.SQL,
    "op5_minhash_dedup": minhash_dedup.SQL,
    "op13_filter_audit": filter_audit.SQL,
}
