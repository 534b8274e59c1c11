"""Registered queries of this subpackage, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketflow.llm.decontamination import op10_decontamination
from docketflow.llm.filter_audit import OP12_SQL, op12_filter_audit
from docketflow.llm.html_extract import op6_html_extraction
from docketflow.llm.license_scan import op13_license_scan
from docketflow.llm.minhash_dedup import op9_minhash_dedup
from docketflow.llm.packing import op8_packing
from docketflow.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from docketflow.llm.quality import op3_quality_classifier
from docketflow.llm.sharding import op7_sharding
from docketflow.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from docketflow.llm.topk_search import OP2_SQL, op2_topk_search
from docketflow.llm.url_filter import OP4_SQL, op4_url_filter
from docketflow.llm.warc import OP5_SQL, op5_warc


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_topk_search": op2_topk_search,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_url_filter": op4_url_filter,
        "op5_warc": op5_warc,
        "op6_html_extraction": op6_html_extraction,
        "op7_sharding": op7_sharding,
        "op8_packing": op8_packing,
        "op9_minhash_dedup": op9_minhash_dedup,
        "op10_decontamination": op10_decontamination,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_filter_audit": op12_filter_audit,
        "op13_license_scan": op13_license_scan,
        "pipeline": corpus_pipeline.run,
    }


def llm_oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op2_topk_search": OP2_SQL, "op4_url_filter": OP4_SQL, "op5_warc": OP5_SQL, "op11_prefix_trie": OP11_SQL, "op12_filter_audit": OP12_SQL}
