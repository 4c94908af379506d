"""The queries of this package, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe_reuse import op3_bpe_chunk_reuse
from .chat import OP9_SQL, op9_chat_fingerprints
from .minhash import op5_probminhash_near_dedup
from .packing import op1_pack_karmarkar_karp
from .pivots import OP2_SQL, op2_pivot_top_k
from .quality import op7_quality_co_training
from .repair import op10_repair_token_files
from .tiff import op4_tiff_media
from .toxicity import op8_toxicity_chain
from .urls import OP6_SQL, op6_url_temporal_list

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack_karmarkar_karp,
        op2_pivot_top_k,
        op3_bpe_chunk_reuse,
        op4_tiff_media,
        op5_probminhash_near_dedup,
        op6_url_temporal_list,
        op7_quality_co_training,
        op8_toxicity_chain,
        op9_chat_fingerprints,
        op10_repair_token_files,
    )
}
ORACLES: dict[str, str] = {"op2_pivot_top_k": OP2_SQL, "op6_url_temporal_list": OP6_SQL, "op9_chat_fingerprints": OP9_SQL}
