"""The training-data queries by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from spanloom.llm.bpe_codec import op1_bpe_codec
from spanloom.llm.decontamination import op6_decontamination
from spanloom.llm.embedding_dedup import OP9_SQL, op9_embedding_dedup
from spanloom.llm.language_id import op10_language_id
from spanloom.llm.near_dedup import op8_near_dedup
from spanloom.llm.secret_scan import op4_secret_scan
from spanloom.llm.sharding import op7_sharding
from spanloom.llm.substring_dedup import OP5_SQL, op5_substring_dedup
from spanloom.llm.token_counts import op2_token_counts
from spanloom.llm.toxicity import op3_toxicity

QUERIES = {
    "op1_bpe_codec": op1_bpe_codec,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_near_dedup": op8_near_dedup,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_language_id": op10_language_id,
}

ORACLES: dict[str, str] = {
    "op5_substring_dedup": OP5_SQL,
    "op9_embedding_dedup": OP9_SQL,
}
