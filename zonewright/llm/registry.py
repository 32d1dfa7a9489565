"""The queries of this subpackage."""

from __future__ import annotations

import corpus_pipeline
from zonewright.llm.chat import OP6_SQL, op6_chat_formatting
from zonewright.llm.fingerprints import op8_document_fingerprints
from zonewright.llm.jaccard_join import op5_ngram_jaccard_join
from zonewright.llm.language import language_id_pages, op2_language_id
from zonewright.llm.licenses import op7_license_scans
from zonewright.llm.merkle import OP12_SQL, op12_merkle_manifest
from zonewright.llm.mixing import op9_mixing_sources
from zonewright.llm.packing import op3_packing
from zonewright.llm.pii import op1_pii_surrogates
from zonewright.llm.quality import op4_quality_rules
from zonewright.llm.sharding import op10_sharding
from zonewright.llm.structure import OP11_SQL, op11_structure_repair
from zonewright.llm.toxicity import op13_toxicity

_QUERIES = (op1_pii_surrogates, op2_language_id, op3_packing, op4_quality_rules, op5_ngram_jaccard_join, op6_chat_formatting, op7_license_scans, op8_document_fingerprints, op9_mixing_sources, op10_sharding, op11_structure_repair, op12_merkle_manifest, op13_toxicity, language_id_pages)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    return {"op6_chat_formatting": OP6_SQL, "op11_structure_repair": OP11_SQL, "op12_merkle_manifest": OP12_SQL}
