"""The registered queries of the operators and of the pipeline, and their SQL where it can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lastword.llm import audit, decontaminate
from lastword.llm.audit import op12_filters
from lastword.llm.decontaminate import op6_decontamination
from lastword.llm.extract import op3_extract
from lastword.llm.jaccard import op9_jaccard
from lastword.llm.lines import op1_lines
from lastword.llm.minhash import op13_minhash
from lastword.llm.packing import op5_packing
from lastword.llm.quality import op10_quality
from lastword.llm.repeats import op2_repeats
from lastword.llm.sharding import op7_sharding
from lastword.llm.topk import op4_topk
from lastword.llm.urls import op8_urls
from lastword.llm.variants import op11_variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lines": op1_lines,
    "op2_repeats": op2_repeats,
    "op3_extract": op3_extract,
    "op4_topk": op4_topk,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_urls": op8_urls,
    "op9_jaccard": op9_jaccard,
    "op10_quality": op10_quality,
    "op11_variants": op11_variants,
    "op12_filters": op12_filters,
    "op13_minhash": op13_minhash,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {"op6_decontamination": decontaminate.SQL, "op12_filters": audit.SQL}
