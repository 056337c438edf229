"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from arrears.llm.conversations import op11_integer_weights
from arrears.llm.decontaminate import op10_suffix_automaton
from arrears.llm.licenses import op9_license_join
from arrears.llm.neighbours import op8_stable_projections
from arrears.llm.packing import op3_concat_cut
from arrears.llm.passages import op4_phrase_automata
from arrears.llm.pii import op1_bootstrap_pii
from arrears.llm.quality import op12_leader_quality
from arrears.llm.runs import op13_synchronising_runs
from arrears.llm.simhash import op7_simhash_pigeonhole
from arrears.llm.token_counts import op5_token_counts
from arrears.llm.toxicity import op2_noisy_channel
from arrears.llm.training_order import op6_training_order

QUERIES: dict[str, Callable] = {q.__name__: q for q in (
    op1_bootstrap_pii, op2_noisy_channel, op3_concat_cut, op4_phrase_automata, op5_token_counts, op6_training_order,
    op7_simhash_pigeonhole, op8_stable_projections, op9_license_join, op10_suffix_automaton,
    op11_integer_weights, op12_leader_quality, op13_synchronising_runs)}

#: DuckDB SQL for the same rows, where SQL can express them.
ORACLES: dict[str, str] = {}
