"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from tidewheel.llm.context_tree import op9_context_tree
from tidewheel.llm.decontamination import op1_template_leaks
from tidewheel.llm.fertility import op10_tokeniser_fertility
from tidewheel.llm.infill import OP12_SQL, op12_wavelet_infill
from tidewheel.llm.link_trust import OP11_SQL, op11_link_trust
from tidewheel.llm.manifest import OP13_SQL, op13_slot_manifest
from tidewheel.llm.near_dedup import OP2_SQL, op2_lsh_forest
from tidewheel.llm.packing import op8_cost_packing
from tidewheel.llm.pii import op7_pii_surrogates
from tidewheel.llm.quality import op6_pu_quality
from tidewheel.llm.repeats import OP4_SQL, op4_cover_repeats
from tidewheel.llm.token_counts import op5_pretoken_counts
from tidewheel.llm.toxicity import op3_toxicity_chain

QUERIES = {
    "op1_template_leaks": op1_template_leaks,
    "op2_lsh_forest": op2_lsh_forest,
    "op3_toxicity_chain": op3_toxicity_chain,
    "op4_cover_repeats": op4_cover_repeats,
    "op5_pretoken_counts": op5_pretoken_counts,
    "op6_pu_quality": op6_pu_quality,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_cost_packing": op8_cost_packing,
    "op9_context_tree": op9_context_tree,
    "op10_tokeniser_fertility": op10_tokeniser_fertility,
    "op11_link_trust": op11_link_trust,
    "op12_wavelet_infill": op12_wavelet_infill,
    "op13_slot_manifest": op13_slot_manifest,
}

ORACLES: dict[str, str] = {
    "op2_lsh_forest": OP2_SQL,
    "op4_cover_repeats": OP4_SQL,
    "op11_link_trust": OP11_SQL,
    "op12_wavelet_infill": OP12_SQL,
    "op13_slot_manifest": OP13_SQL,
}
