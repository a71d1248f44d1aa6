"""The queries of this package, and the SQL that some of them are checked against."""

from __future__ import annotations

from . import licenses, negatives, warc
from .decontam import op5_decontamination
from .jaccard import op10_jaccard_join
from .langid import op9_language_id
from .licenses import op8_license_scan
from .lm import op6_lm_scores
from .mixing import op4_source_mixing
from .negatives import op13_hard_negatives
from .periodic import op11_periodic_runs
from .quality import op7_quality_rules
from .secrets import op3_secret_ledger
from .substrings import op2_substring_dedup
from .tokenids import op12_token_ids
from .warc import op1_warc_normalise

QUERIES = {
    "op1_warc_normalise": op1_warc_normalise,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_ledger": op3_secret_ledger,
    "op4_source_mixing": op4_source_mixing,
    "op5_decontamination": op5_decontamination,
    "op6_lm_scores": op6_lm_scores,
    "op7_quality_rules": op7_quality_rules,
    "op8_license_scan": op8_license_scan,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_ids": op12_token_ids,
    "op13_hard_negatives": op13_hard_negatives,
}
SQL: dict[str, str] = {**licenses.SQL, **negatives.SQL, **warc.SQL}
