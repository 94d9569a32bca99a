"""The queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.llm.alignment import op11_alignment
from wardline.llm.byte_bpe import op8_byte_bpe
from wardline.llm.embedding_dedup import OP7_SQL, op7_embedding_dedup
from wardline.llm.fingerprints import op3_fingerprints
from wardline.llm.language_id import op5_language_id
from wardline.llm.lexical import OP13_SQL, op13_ranked_search
from wardline.llm.minhash_dedup import OP2_SQL, op2_minhash_dedup
from wardline.llm.mixing import OP4_SQL, op4_mixing
from wardline.llm.packing import op12_packing
from wardline.llm.quality import op9_quality
from wardline.llm.sharding import op10_sharding
from wardline.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from wardline.llm.toxicity import op6_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_substring_dedup,
        op2_minhash_dedup,
        op3_fingerprints,
        op4_mixing,
        op5_language_id,
        op6_toxicity,
        op7_embedding_dedup,
        op8_byte_bpe,
        op9_quality,
        op10_sharding,
        op11_alignment,
        op12_packing,
        op13_ranked_search,
    )
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_minhash_dedup": OP2_SQL,
    "op4_mixing": OP4_SQL,
    "op7_embedding_dedup": OP7_SQL,
    "op13_ranked_search": OP13_SQL,
}
